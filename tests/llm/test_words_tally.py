from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import pytest
from hypothesis import given, settings, strategies as st

from tabulyte.llm import tally, words

texts = st.lists(st.one_of(st.none(), st.text(alphabet="ab \n\té漢 \U0001f600", max_size=30)), max_size=8)


@given(texts)
@settings(max_examples=300, deadline=None)
def test_words_and_windows(values):
    column = pa.chunked_array([pa.array(values[:3], pa.string()), pa.array(values[3:], pa.string())])
    data, offsets = words.text_bytes(column)
    begin, end = words.word_spans(data, offsets)
    bounds = words.text_of(begin, offsets)
    split = [(v or "").encode().split() for v in values]
    assert [bytes(data[a:b]) for a, b in zip(begin, end)] == [w for ws in split for w in ws]
    assert np.diff(bounds).tolist() == [len(ws) for ws in split]
    assert words.text_sizes(pa.array(values, pa.string())).tolist() == [len((v or "").encode()) for v in values]
    hashes = words.word_hashes(data, begin, end)
    flat = [w for ws in split for w in ws]
    assert len(set(zip(flat, hashes.tolist()))) == len(set(flat)) == len(set(hashes.tolist()))
    first, keys, second = words.windows(hashes, bounds, 2)
    expected = [tuple(ws[a : a + 2]) for ws in split for a in range(len(ws) - 1)]
    assert [tuple(flat[f : f + 2]) for f in first] == expected
    for h in (keys, second):
        assert len(set(zip(expected, h.tolist()))) == len(set(expected)) == len(set(h.tolist()))


def test_words_longer_than_a_slice(monkeypatch):
    monkeypatch.setattr(words, "_SLICE", 8)
    value = "x" * 50 + " ab cd " + "y" * 20 + " ab " + "x" * 50
    data, offsets = words.text_bytes(pa.array([value]))
    begin, end = words.word_spans(data, offsets)
    h = words.word_hashes(data, begin, end)
    assert h[0] == h[5] and h[1] == h[4] and len(set(h.tolist())) == 4


@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**62)), max_size=40))
@settings(max_examples=200, deadline=None)
def test_packed_numbers(values):
    a = np.array(values, np.int64)
    assert (tally.unpacked(tally.packed(a), len(a)) == a).all()


@pytest.mark.parametrize("encode", [tally.exact, tally.magnitude])
def test_totals_return_in_order(spark, encode):
    layout = tally.Layout(4, 7)
    rng = np.random.default_rng(2)
    held = {u: rng.integers(0, 40, 60).astype(np.uint64) for u in range(4)}
    made = {u: tally.Keys.of(k, words.mix(k, 1), layout) for u, k in held.items()}
    sent = pa.concat_tables([made[u].blobs(u, made[u].summed()) for u in held])
    found = tally.add_up(spark.createDataFrame(sent.to_pandas(), tally.BLOBS).repartition(3), encode).toArrow()
    everything = Counter(int(k) for v in held.values() for k in v)
    for u, keys in made.items():
        totals = keys.totals(found.filter(pa.compute.equal(found.column("unit"), u)))
        assert totals.tolist() == encode(np.array([everything[int(k)] for k in keys.keys])).tolist()
        assert (keys.keys[keys.place] == held[u]).all()
