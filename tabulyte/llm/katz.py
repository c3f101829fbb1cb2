"""A bigram language model with Katz backoff.

Counts of words and word pairs come from the training documents, add up in Spark per
key and stand in written tables, divided by unit and bucket.  Good-Turing discounts
follow from the counts of counts.  The backoff weight of a history is what the discounts
leave of its mass, divided by what the unigrams leave after the words seen with it; both
are exact sums over the distinct pairs of the corpus.  A token's probability is its
discounted pair estimate, else backoff weight times the unigram estimate."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tabulyte.llm import tally, words
from tabulyte.llm.scratch import kept

#: Counts above this are not discounted.
MOST = 5
_U = np.uint64
_END, _START = _U(0x2545F4914F6CDD1D), _U(0x9E6C63D0876A9A35)


def discounts(n: np.ndarray, most: int = MOST) -> np.ndarray:
    """Good-Turing factors of the counts 0 .. `most` + 1 from the counts of counts n[r]
    (n[0] unused, n[most + 1] the last); a factor that is not in (0, 1) becomes 1."""
    factor = np.ones(most + 2)
    if n[1] > 0:
        tail = (most + 1) * n[most + 1] / n[1]
        for r in range(1, most + 1):
            if n[r] > 0 and tail < 1:
                d = ((r + 1) * n[r + 1] / (r * n[r]) - tail) / (1 - tail)
                factor[r] = d if 0 < d < 1 else 1.0
    return factor


@dataclass(frozen=True)
class Totals:
    """What the model holds besides its tables."""

    tokens: int
    types: int
    one: np.ndarray
    two: np.ndarray
    left: float  # counts that the discounts of the unigrams leave

    def unigram(self, counts: np.ndarray) -> np.ndarray:
        """Probability of a word by its training count; where no discount leaves any mass
        for unknown words, one count is spared."""
        left = self.left or 1.0
        mass = self.tokens + (not self.left)
        return np.where(counts > 0, self.one[np.minimum(counts, MOST + 1)] * counts, left) / mass


class _Unit:
    """Tokens of a unit's texts (an end after each), their words and word pairs."""

    def __init__(self, table: pa.Table, layout: tally.Layout):
        data, offsets = words.text_bytes(table.column("text"))
        data = words.LOWER[data]
        begin, end = words.word_spans(data, offsets)
        bounds = words.text_of(begin, offsets)
        token = np.insert(words.word_hashes(data, begin, end), bounds[1:], _END)
        self.edges = bounds + np.arange(len(bounds))
        history = np.empty_like(token)
        history[1:] = token[:-1]
        history[self.edges[:-1]] = _START
        held = table.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
        self.learnt = np.repeat(~held, np.diff(self.edges)).astype(np.float64)
        # the start is a word of its own for the histories' tables; it is no token
        self.word = tally.Keys.of(np.append(token, _START), words.mix(np.append(token, _START), 4), _one(layout))
        self.token, self.start = self.word.place[:-1], int(self.word.place[-1])
        self.history = np.append(self.token[-1:], self.token[:-1])
        self.history[self.edges[:-1]] = self.start
        pair = words.mix(history * _U(0xD6E8FEB86659FD93) + token, 6)
        second = words.mix(history ^ (words.mix(token, 8) * _U(0xA0761D6478BD642F)), 7)
        two = tally.Keys.of(pair, second, layout)
        self.pair = replace(two, buckets=two.buckets + _one(layout).buckets)

    def counts(self, rows: pa.Table, keys: tally.Keys) -> tuple[np.ndarray, np.ndarray]:
        """Training counts of the keys, and whether this unit stands for a key."""
        coded = _in_order(rows, keys)
        return coded >> 1, (coded & 1).astype(bool)


def _one(layout: tally.Layout) -> tally.Layout:
    """Buckets of words; those of pairs follow, those of histories come last."""
    return replace(layout, buckets=max(1, layout.buckets // 4))


def _in_order(rows: pa.Table, keys: tally.Keys) -> np.ndarray:
    """Returned numbers in the order of `keys`."""
    given = dict(zip(rows.column("bucket").to_pylist(), rows.column("totals").to_pylist()))
    buckets, sizes = np.unique(keys.buckets, return_counts=True)
    return tally.numbers((given[b] for b in buckets.tolist()), sizes.tolist())


def _send(layout: tally.Layout, table: pa.Table) -> pa.Table:
    unit, number = _Unit(table, layout), table.column("unit")[0].as_py()
    one = unit.word.summed(np.append(unit.learnt, 0.0))
    return pa.concat_tables([unit.word.blobs(number, one), unit.pair.blobs(number, unit.pair.summed(unit.learnt))])


def _grouped(table: pa.Table):
    """Blobs of a bucket by unit; bounds, keys, their order and where each key begins."""
    table = table.sort_by("unit")
    blobs = table.column("keys").to_pylist()
    edges = np.concatenate([[0], np.cumsum([len(b) // 8 for b in blobs])])
    keys = np.frombuffer(b"".join(blobs), _U)
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    return table, edges, order, np.flatnonzero(new), np.cumsum(new) - 1


def _count(layout: tally.Layout, table: pa.Table) -> pa.Table:
    """Totals by key as 2 * count + (1 for the first unit that saw it in training), and
    the bucket's counts of counts in a row of unit -1 (words) or -2 (pairs)."""
    table, edges, order, first, group = _grouped(table)
    counts = tally.numbers(table.column("counts").to_pylist(), np.diff(edges))[order]
    sums = np.add.reduceat(counts, first, dtype=np.int64)
    seen = np.flatnonzero(counts > 0)
    _, at = np.unique(group[seen], return_index=True)
    coded = 2 * sums[group]
    coded[seen[at]] += 1
    out = np.empty_like(coded)
    out[order] = coded
    bucket = table.column("bucket")[0].as_py()
    known = sums[sums > 0]
    summary = np.append(np.bincount(np.minimum(known, MOST + 2), minlength=MOST + 3), known.sum()).astype(np.int64)
    return pa.table({
        "unit": pa.array([*table.column("unit").to_pylist(), -1 if bucket < _one(layout).buckets else -2], pa.int32()),
        "bucket": pa.array([bucket] * (table.num_rows + 1), pa.int32()),
        "totals": pa.array([*(tally.packed(out[a:b]) for a, b in zip(edges[:-1], edges[1:])), summary.tobytes()], pa.binary()),
    })


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for unit, blob in zip(batch.column("unit").to_pylist(), batch.column("totals").to_pylist()):
            sums[unit] = sums.get(unit, 0) + np.frombuffer(blob, np.int64)
    yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.int64()))], ["unit", "n"])


def _totals(counted: DataFrame) -> Totals:
    rows = counted.filter("unit < 0").select("unit", "totals").mapInArrow(_summed, "unit int, n array<long>").collect()  # a row or two per partition
    n = {k: np.sum([r.n for r in rows if r.unit == k] or [[0] * (MOST + 4)], axis=0) for k in (-1, -2)}
    one, two = discounts(n[-1]), discounts(n[-2])
    r = np.arange(1, MOST + 1)
    left = float(((1 - one[1 : MOST + 1]) * r * n[-1][1 : MOST + 1]).sum())
    return Totals(int(n[-1][-1]), int(n[-1][:-1].sum()), one, two, left)


_PARTS = "unit int, bucket int, keys binary, mass binary, seen binary"


def _histories(layout: tally.Layout, totals: Totals, table: pa.Table, rows: pa.Table) -> pa.Table:
    """What the pairs that this unit stands for add to their histories: discounted mass and
    unigram mass of the words seen, for every training history in the unit's texts."""
    unit, number = _Unit(table, layout), table.column("unit")[0].as_py()
    one, _ = unit.counts(rows, unit.word)
    two, own = unit.counts(rows, unit.pair)
    n = len(unit.word.keys)
    history, token = np.zeros(len(two), np.int64), np.zeros(len(two), np.int64)
    history[unit.pair.place], token[unit.pair.place] = unit.history, unit.token
    history, token, two = history[own], token[own], two[own]
    mass = np.bincount(history, (1 - totals.two[np.minimum(two, MOST + 1)]) * two, minlength=n)
    seen = np.bincount(history, totals.unigram(one[token]), minlength=n)
    use = one > 0
    use[unit.start] = True
    keys = tally.Keys(unit.word.keys[use], np.zeros(0, np.int64), unit.word.buckets[use])
    edges = np.flatnonzero(np.diff(keys.buckets, prepend=-1, append=-1))
    mass, seen = mass[use], seen[use]
    pairs = list(zip(edges[:-1], edges[1:]))
    column = lambda x, form: pa.array([form(x[a:b]) for a, b in pairs], pa.binary())
    return pa.table({
        "unit": pa.array([number] * len(pairs), pa.int32()), "bucket": pa.array(keys.buckets[edges[:-1]], pa.int32()),
        "keys": column(keys.keys, np.ndarray.tobytes), "mass": column(mass, tally.squeezed), "seen": column(seen, tally.squeezed)})


def _backoff(shift: int, table: pa.Table) -> pa.Table:
    """Mass left by mass open for every history, negative where no discount left any and
    one count is spared instead."""
    table, edges, order, first, group = _grouped(table)
    whole = lambda name: np.frombuffer(b"".join(map(tally.released, table.column(name).to_pylist())), np.float64)[order]
    mass, seen = np.add.reduceat(whole("mass"), first), np.add.reduceat(whole("seen"), first)
    left = np.where(mass > 0, mass, -1.0) / np.maximum(1 - seen, 1e-300)
    out = np.empty(len(order))
    out[order] = left[group]
    return pa.table({
        "unit": table.column("unit"), "bucket": pa.array([b + shift for b in table.column("bucket").to_pylist()], pa.int32()),
        "totals": pa.array([tally.squeezed(out[a:b]) for a, b in zip(edges[:-1], edges[1:])], pa.binary())})


def _score(layout: tally.Layout, totals: Totals, shift: int, table: pa.Table, rows: pa.Table) -> pa.Table:
    unit = _Unit(table, layout)
    one, _ = unit.counts(rows, unit.word)
    two, _ = unit.counts(rows, unit.pair)
    given = dict(zip(rows.column("bucket").to_pylist(), rows.column("totals").to_pylist()))
    use = one > 0
    use[unit.start] = True
    left = np.zeros(len(one))
    left[use] = np.frombuffer(b"".join(tally.released(given[b + shift]) for b in np.unique(unit.word.buckets[use]).tolist()), np.float64)
    end = unit.token[unit.edges[1:] - 1][0]
    times = one.copy()
    times[unit.start] = one[end]  # a text starts as often as it ends
    word, pair, past = one[unit.token], two[unit.pair.place], times[unit.history]
    weight = left[unit.history]
    lower = totals.unigram(word)
    spread = np.maximum(past + (weight < 0), 1)
    p = np.where(pair > 0, totals.two[np.minimum(pair, MOST + 1)] * pair / spread, np.where(past > 0, np.abs(weight) / spread, 1.0) * lower)
    base = np.log10((word + 0.5) / (totals.tokens + 0.5 * (totals.types + 1)))
    each = lambda x: np.add.reduceat(x, unit.edges[:-1])
    return pa.table({
        "doc_id": table.column("doc_id"), "held_out": table.column("held_out"), "n_tokens": pa.array(np.diff(unit.edges), pa.int64()),
        "n_known": pa.array(each((word > 0).astype(np.int64)), pa.int64()), "train_tokens": pa.array(np.full(table.num_rows, totals.tokens), pa.int64()),
        "base_score": pa.array(each(base)), "score": pa.array(each(np.log10(p)))})


def katz_scores(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score
    and score, the log10 probability of its tokens.

    Tokens are words (A-Z lower-cased) and one end per text; the first token's history is a
    start.  Training texts are those where `held_out` is not true.  A null or empty text is
    its end alone.  Words not in training share one type, `unknown`, so that the unigrams
    and every history's pairs with their backoff sum to 1.  Histories not in training use
    the unigrams.  Without training texts every score is 0.  Repeated rows count and are
    scored as often as they come; columns other than the id and the text are ignored."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col(text_col).alias("text"))
    layout = tally.Layout.of(docs)
    units = tally.in_units(docs, layout, "doc_id", "text")
    shift = _one(layout).buckets + layout.buckets

    def send(table: pa.Table) -> pa.Table:
        return _send(layout, table)

    def count(table: pa.Table) -> pa.Table:
        return _count(layout, table)

    counted = kept(units.groupBy("unit").applyInArrow(send, tally.BLOBS).groupBy("bucket").applyInArrow(count, tally.TOTALS), "counts")
    totals = _totals(counted)
    by_unit = counted.filter("unit >= 0")

    def histories(table: pa.Table, rows: pa.Table) -> pa.Table:
        return _histories(layout, totals, table, rows)

    def backoff(table: pa.Table) -> pa.Table:
        return _backoff(shift, table)

    def score(table: pa.Table, rows: pa.Table) -> pa.Table:
        return _score(layout, totals, shift, table, rows)

    parts = units.groupBy("unit").cogroup(by_unit.groupBy("unit")).applyInArrow(histories, _PARTS)
    weights = kept(parts.groupBy("bucket").applyInArrow(backoff, tally.TOTALS), "backoff")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return units.groupBy("unit").cogroup(by_unit.unionByName(weights).groupBy("unit")).applyInArrow(
        score, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
