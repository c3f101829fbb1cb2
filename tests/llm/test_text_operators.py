"""Line chunks, substrings, shingle joins and decontamination against brute force."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tabulyte.llm import decontaminate as dec, ngram_join
from tabulyte.llm.components import components
from tabulyte.llm.ngram_join import ngram_components
from tabulyte.llm.substring_dedup import substring_dedup

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def by_text(found, *columns):
    return Counter(tuple(r[c] for c in columns) for r in found.collect())


# substrings


def substring_brute(rows, width):
    split = [(t or "").encode().split() for _, t, *_ in rows]
    seen = Counter(tuple(w[a : a + width]) for w in split for a in range(len(w) - width + 1))
    out = Counter()
    for (i, *_), w in zip(rows, split):
        gone = [False] * len(w)
        for a in range(len(w) - width + 1):
            if seen[tuple(w[a : a + width])] > 1:
                gone[a : a + width] = [True] * width
        out[(i, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode())] += 1
    return out


@pytest.mark.parametrize("width", [2, 5, 35])
def test_substrings_like_brute_force(docs, rows, width):
    assert by_text(substring_dedup(docs, width), "doc_id", "n_words", "n_removed", "kept_text") == substring_brute(rows, width)


def test_substring_spans_are_maximal_and_in_the_text(docs, rows):
    for r in substring_dedup(docs, 5).collect():
        spans = [(s.start, s.end) for s in r.removed]
        assert sum(b - a for a, b in spans) == r.n_removed
        assert all(a < b <= r.n_words for a, b in spans) and all(x[1] < y[0] for x, y in zip(spans, spans[1:]))


def test_substrings_of_an_empty_table(none):
    assert substring_dedup(none).count() == 0


def test_substrings_of_real_documents(table):
    docs = table("documents")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert by_text(substring_dedup(docs), "doc_id", "n_words", "n_removed", "kept_text") == substring_brute(rows, 35)


# shingle join


def join_brute(rows, width, percent):
    sets = {}
    for k, (i, t, *_) in enumerate(rows):
        w = (t or "").encode().translate(LOWER).split()
        sets[k] = frozenset(tuple(w[a : a + width]) for a in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)] if w else [])
    parent = {k: k for k in sets}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    holders = {}
    for k, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(k)
    for k, s in sets.items():
        common = Counter(j for x in s for j in holders[x] if j < k)
        for j, n in common.items():
            if rows[k][0] is not None and rows[j][0] is not None and 100 * n >= percent * (len(s) + len(sets[j]) - n):
                parent[root(k)] = root(j)
    least = {}
    for k in sets:
        if rows[k][0] is not None:
            least[root(k)] = min(least.get(root(k), rows[k][0]), rows[k][0])
    return Counter((rows[k][0], len(s), least[root(k)] if rows[k][0] is not None else None) for k, s in sets.items())


@pytest.mark.parametrize("width, percent", [(4, 85), (2, 60), (5, 80)])
def test_components_like_brute_force(docs, rows, width, percent):
    assert by_text(ngram_components(docs, width, percent), "doc_id", "n_shingles", "component_id") == join_brute(rows, width, percent)


def test_components_of_large_divided_groups(spark, monkeypatch):
    """Chains of small changes, many near copies of two texts and texts of common
    passages, with groups divided and visitors salted at tiny sizes."""
    rng = random.Random(11)
    word = lambda: f"v{rng.randrange(5000)}"
    passages = [" ".join(word() for _ in range(60)) for _ in range(3)]
    texts = []
    for start in range(2):
        text = [word() for _ in range(70)]
        for _ in range(90):
            near = list(text)
            near[rng.randrange(70)] = word()
            texts.append(" ".join(near))
        for _ in range(40):  # a chain that drifts away
            text[rng.randrange(70)] = word()
            texts.append(" ".join(text))
    texts += [" ".join([rng.choice(passages), *(word() for _ in range(rng.randrange(1, 90)))]) for _ in range(60)]
    rng.shuffle(texts)
    rows = [(1000 - k, t) for k, t in enumerate(texts)]
    monkeypatch.setattr(ngram_join, "GROUP", 8)
    monkeypatch.setattr(ngram_join, "VISITORS", 4)
    found = ngram_components(spark.createDataFrame(rows, "doc_id long, text string"), 4, 85)
    assert by_text(found, "doc_id", "n_shingles", "component_id") == join_brute(rows, 4, 85)


def test_components_of_an_empty_table(none):
    assert ngram_components(none).count() == 0


def test_component_labels(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 90), (90, 95), (100, 90)], "a long, b long")
    assert {r.node: r.label for r in components(edges).collect()} == {i: 0 for i in range(41)} | {90: 90, 95: 90, 100: 90}
    assert components(edges.limit(0)).count() == 0


# decontamination


def contamination_brute(rows, items, window):
    windows = {}
    for i, t in items:
        w = dec.normalised(t)
        for a in range(max(1, len(w) - window + 1) if w else 0):
            windows.setdefault(tuple(w[a : a + window]), set()).add("" if i is None else str(i))
    out = Counter()
    for i, t, *_ in rows:
        w = dec.normalised(t)
        hit, found = [False] * len(w), set()
        for size in {len(x) for x in windows}:
            for a in range(len(w) - size + 1):
                if tuple(w[a : a + size]) in windows:
                    hit[a : a + size] = [True] * size
                    found |= windows[tuple(w[a : a + size])]
        out[i, len(w), tuple(k for k, h in enumerate(hit) if h), tuple(sorted(found))] += 1
    return out


def flat(found):
    return Counter((r.doc_id, r.n_words, tuple(k for s in r.spans for k in range(s.start, s.end)), tuple(r.items)) for r in found.collect())


@pytest.mark.parametrize("window, block", [(4, 50_000), (3, 40), (10, 50_000)])
def test_matches_like_brute_force(spark, docs, rows, monkeypatch, window, block):
    rng = random.Random(3)
    monkeypatch.setattr(dec, "BLOCK_WORDS", block)
    monkeypatch.setattr(dec, "PIECE_WORDS", 20)
    whole = [r[1].split() for r in rows if r[1] and len(r[1].split()) > 60]
    items = [(k, " ".join(w[a : a + n])) for k, (w, a, n) in enumerate((rng.choice(whole), rng.randrange(40), rng.choice([2, 3, 9, 10, 15, 90])) for _ in range(25))]
    items += [(None, "one two"), (7, None), (8, ""), (9, "One, TWO!"), (9, "漢字"), (3, items[3][1]), (1, "é ñ")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert flat(dec.matched(docs, bench, window)) == contamination_brute(rows, items, window)


def test_matches_of_real_documents(table):
    docs, bench = table("documents"), table("benchmark")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert flat(dec.matched(docs, bench)) == contamination_brute(rows, [tuple(r) for r in bench.select("item_id", "text").collect()], 10)


def test_cut_texts(spark):
    bench = spark.createDataFrame([(1, " ".join(f"q{k}" for k in range(12)))], "item_id long, text string")
    passage = ", ".join(f"Q{k}" for k in range(12))
    clean = " ".join(f"c{k}" for k in range(30))
    rows = [(1, f"{clean} {passage}. {clean}"), (2, passage), (3, clean), (4, None), (5, "")]
    out = {r.doc_id: r for r in dec.decontaminate(spark.createDataFrame(rows, "doc_id long, text string").withColumn("spans", F.lit("own")), bench).collect()}
    assert out[1].text == f"{clean} {clean}" and 2 not in out and out[3].text == clean and out[4].text is None and out[5].text == "" and out[3].spans == "own"


def test_columns_of_any_name_pass_through(spark):
    bench = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    docs = spark.createDataFrame([("k", "x y", 5, 6, 7)], "key string, body string, doc_id long, row long, text long")
    out = dec.decontaminate(docs, bench, id_col="key", text_col="body")
    assert out.columns == docs.columns and out.collect() == docs.collect()


def test_empty_tables_match_nothing(spark, docs, none):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert dec.matched(docs, bench).filter(F.size("spans") > 0).count() == 0
    assert dec.matched(none, bench).count() == 0
