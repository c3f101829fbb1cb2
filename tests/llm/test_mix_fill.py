"""The fill of a source goes on past documents that do not fit."""

from collections import Counter

import pytest

from tabulyte.llm.mixing import mix


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_a_very_long_document_leaves_no_gap(spark, seed):
    sizes = {i: 3 + i % 25 for i in range(400)}
    sizes[400] = 3 * sum(sizes.values()) // 2  # 60% of the words, twice the target
    docs = spark.createDataFrame([(i, "w " * n, "a") for i, n in sizes.items()], "doc_id long, text string, source string")
    out = mix(docs, share=0.3, seed=seed).collect()
    taken = sum(r.size * r.copies for r in out)
    assert len(out) == 401 and all(r.copies in (0, 1) for r in out)
    assert abs(taken - out[0].target) <= 3
    assert Counter(out) == Counter(mix(docs.repartition(3), share=0.3, seed=seed).collect())
    free = [r.size for r in out if not r.copies]
    assert not [n for n in free if n <= out[0].target - taken]
