"""Vector codes: a codebook per part of the vectors, trained by active-entry Lloyd rounds.

Components become whole numbers, so every distance, sum and mean is exact and equal on
every run.  A row carries, for each part, its entry and the exact distance to it.  In a
round a part whose entry has not moved since compares only the entries that did move
against the stored distance: no other entry can have come closer.  A part whose entry
moved looks at all entries again.  Equal distances go to the lower index in both cases.

Codebooks are `entries` x dimension numbers; they are on the driver and sent to the
tasks.  Vectors stay in Spark: a round writes the rows with their new codes to the shared
folder, and sums per part and entry, added up in each task first, give the next codebook.

Rows with a null vector, or one with a null or non-finite component, are left out, as
are vectors whose length differs from the first one's (least id, then least vector).
Ids may be null (they come last when the first codebook is chosen) and may repeat; each
row stands for itself.  With fewer rows than entries there are as many entries as rows.
An empty table gives an empty result.  Components of 2**16 and more do not fit the exact
arithmetic and raise an error."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tabulyte.llm.scratch import dropped, kept

SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
LARGEST = 1 << 26
_CELLS = 4_000_000  # numbers of one distance block


def bounds(dimension: int, parts: int) -> list[tuple[int, int]]:
    """First and end component of each part."""
    return [(i * dimension // parts, (i + 1) * dimension // parts) for i in range(parts)]


def distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of every row to every entry, as whole numbers."""
    top = max(np.abs(x).max(initial=0), np.abs(entries).max(initial=0))
    if 4.0 * x.shape[1] * float(top) ** 2 < 2.0**53:  # every partial sum is exact in a double
        a, b = x.astype(np.float64), entries.astype(np.float64)
        return ((a**2).sum(1)[:, None] - 2 * (a @ b.T) + (b**2).sum(1)).astype(np.int64)
    return np.stack([((x - e) ** 2).sum(1) for e in entries.astype(np.int64)], 1)


def _nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lowest nearest entry and its distance, in blocks of rows."""
    index, least = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
    step = max(1, _CELLS // max(1, len(entries)))
    for at in range(0, len(x), step):
        d = distances(x[at : at + step], entries)
        index[at : at + step] = d.argmin(1)
        least[at : at + step] = d.min(1)
    return index, least


@dataclass(frozen=True)
class Codebooks:
    """Per part the entries, and which of them differ from the round before."""

    entries: tuple[np.ndarray, ...]
    moved: tuple[np.ndarray, ...]

    @staticmethod
    def first(vectors: np.ndarray, parts: int) -> Codebooks:
        entries = tuple(vectors[:, a:b] for a, b in bounds(vectors.shape[1], parts))
        return Codebooks(entries, tuple(np.ones(len(e), bool) for e in entries))

    def replaced(self, sums: dict[tuple[int, int], np.ndarray], counts: dict[tuple[int, int], int]) -> Codebooks:
        """Each entry becomes the floor of its parts' mean; unused ones stay."""
        after = [e.copy() for e in self.entries]
        for (part, entry), s in sums.items():
            after[part][entry] = s // counts[part, entry]
        return Codebooks(tuple(after), tuple((a != b).any(1) for a, b in zip(after, self.entries)))

    def digest(self) -> str:
        numbers = (str(v) for e in self.entries for v in e.ravel().tolist())
        return hashlib.sha256(",".join(numbers).encode()).hexdigest()

    def assign(self, x: np.ndarray, code: np.ndarray | None, dist: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """Entry and distance of each part of each row; rows without codes scan all entries."""
        new_code, new_dist = np.empty((len(x), len(self.entries)), np.int64), np.empty((len(x), len(self.entries)), np.int64)
        for p, (a, b) in enumerate(bounds(x.shape[1], len(self.entries))):
            part = x[:, a:b]
            if code is None:
                new_code[:, p], new_dist[:, p] = _nearest(part, self.entries[p])
                continue
            index, least = code[:, p].copy(), dist[:, p].copy()
            changed = np.flatnonzero(self.moved[p])
            again = self.moved[p][index]
            index[again], least[again] = _nearest(part[again], self.entries[p])
            still = np.flatnonzero(~again)
            if len(changed) and len(still):
                best, d = _nearest(part[still], self.entries[p][changed])
                best = changed[best]
                wins = (d < least[still]) | ((d == least[still]) & (best < index[still]))
                index[still[wins]], least[still[wins]] = best[wins], d[wins]
            new_code[:, p], new_dist[:, p] = index, least
        return new_code, new_dist


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width).astype(np.int64)


def _listed(m: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.arange(0, m.size + 1, m.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(m.ravel(), kind))


def _assigned(rows: DataFrame, books: Codebooks, dimension: int) -> DataFrame:
    """The rows with new codes and distances."""
    known = [f for f in rows.schema.fields if f.name not in ("_code", "_dist")]
    schema = T.StructType([*known, T.StructField("_code", T.ArrayType(T.IntegerType())), T.StructField("_dist", T.ArrayType(T.LongType()))])
    shared, parts, first = rows.sparkSession.sparkContext.broadcast(books), len(books.entries), "_code" not in rows.columns
    names = [f.name for f in known]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            before = (None, None) if first else (_matrix(b.column("_code"), parts), _matrix(b.column("_dist"), parts))
            code, dist = shared.value.assign(_matrix(b.column("_x"), dimension), *before)
            yield pa.RecordBatch.from_arrays([*[b.column(n) for n in names], _listed(code, pa.int32()), _listed(dist, pa.int64())], schema.names)

    return rows.mapInArrow(run, schema)


def _sums(rows: DataFrame, books: Codebooks, dimension: int) -> tuple[dict, dict]:
    """Componentwise sums and counts of the parts of each entry."""
    edges, entries = bounds(dimension, len(books.entries)), len(books.entries[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((entries, dimension), np.int64), np.zeros((len(edges), entries), np.int64)
        for b in batches:
            x, code = _matrix(b.column("_x"), dimension), _matrix(b.column("_code"), len(edges))
            for p, (lo, hi) in enumerate(edges):
                order = np.argsort(code[:, p], kind="stable")
                used, start = np.unique(code[order, p], return_index=True)
                if len(used):
                    total[used, lo:hi] += np.add.reduceat(x[order, lo:hi], start, axis=0)
                count[p] += np.bincount(code[:, p], minlength=entries)
        part, entry = np.nonzero(count)
        sums = [total[e, edges[p][0] : edges[p][1]].tolist() for p, e in zip(part, entry)]
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(count[part, entry]), pa.array(sums, pa.list_(pa.int64()))], ["part", "entry", "n", "s"])

    partial = rows.select("_x", "_code").mapInArrow(run, "part int, entry int, n long, s array<long>")
    width = max(b - a for a, b in edges)
    added = partial.groupBy("part", "entry").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.get("s", F.lit(i))) for i in range(width)]).alias("s"))
    sums, counts = {}, {}
    for r in added.collect():  # at most parts x entries rows
        a, b = edges[r["part"]]
        sums[r["part"], r["entry"]] = np.array(r["s"][: b - a], np.int64)
        counts[r["part"], r["entry"]] = r["n"]
    return sums, counts


def _whole(vectors: DataFrame, id_col: str, vector: str, carry: list[str], scale: int) -> DataFrame:
    """Rows with usable vectors, as whole numbers in `_x`."""
    number = F.col(vector)
    usable = F.size(number) > 0
    usable &= F.forall(number, lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < F.lit(float("inf"))))
    outside = F.exists(F.col("_x"), lambda v: F.abs(v) >= F.lit(float(LARGEST)))
    scaled = vectors.filter(usable).select(*[F.col(c) for c in dict.fromkeys([id_col, *carry])], F.transform(number, lambda v: F.floor(v.cast("double") * scale)).alias("_x"))
    checked = F.when(outside, F.raise_error(F.lit(f"a vector component of {LARGEST // scale} or more is too large for exact distances"))).otherwise(F.col("_x"))
    return scaled.withColumn("_x", checked.cast("array<int>"))


def vector_codes(
    vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", carry: list[str] | None = None,
    scale: int = SCALE, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
) -> tuple[DataFrame, Codebooks]:
    """Rows with the id, the `carry` columns, `_code` (an entry per part) and `_dist` (its
    exact squared distance), and the final codebooks."""
    carry = list(carry or [])
    spark = vectors.sparkSession
    rows = kept(_whole(vectors, id_col, vector, carry, scale), "vectors")
    first = [r["_x"] for r in rows.orderBy(F.col(id_col).asc_nulls_last(), "_x").select("_x").limit(entries).collect()]
    dimension = len(first[0]) if first else parts
    first = [x for x in first if len(x) == dimension]
    books = Codebooks.first(np.array(first, np.int64).reshape(-1, dimension), parts)
    if not first:
        return rows.withColumns({"_code": F.array().cast("array<int>"), "_dist": F.array().cast("array<bigint>")}).drop("_x"), books
    state, old = rows.filter(F.size("_x") == dimension), rows
    for _ in range(rounds):
        state = kept(_assigned(state, books, dimension), "codes")
        dropped(old)
        old = state
        books = books.replaced(*_sums(state, books, dimension))
    final = kept(_assigned(state, books, dimension).drop("_x"), "codes")
    dropped(old)
    return final, books
