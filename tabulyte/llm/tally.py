"""Counts of 64-bit keys over a whole corpus, brought back to where the keys arose.

Texts are dealt into units of a few MB by a hash of the row.  A unit sends each of
its distinct keys once, with its own count, packed by bucket; the task of a bucket
adds the counts of all units and returns them in the order they came.  A key that a
third of all rows hold is thus at most one entry per unit.  The unit, read again,
finds the same keys in the same order and takes its totals, so neither positions nor
row ids travel.  Two keys count as equal if key and bucket agree; the bucket comes
from a second hash and buckets grow with the data, so the expected number of false
matches grows only in proportion to it."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from tabulyte.llm.scratch import partitions

UNIT_BYTES = 2 << 20
BUCKET_BYTES = 8 << 20
BLOBS = "unit int, bucket int, keys binary, counts binary"
TOTALS = "unit int, bucket int, totals binary"
_BLOBS = pa.schema([("unit", pa.int32()), ("bucket", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])
_TOTALS = pa.schema([("unit", pa.int32()), ("bucket", pa.int32()), ("totals", pa.binary())])


@dataclass(frozen=True)
class Layout:
    """Numbers of units and buckets; both follow from the bytes of the input."""

    units: int
    buckets: int

    @staticmethod
    def of(df: DataFrame, text: str = "text") -> Layout:
        total = df.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
        n = partitions(df.sparkSession)
        return Layout(max(n, -(-total // UNIT_BYTES)), max(2 * n, -(-total // BUCKET_BYTES)))


def in_units(df: DataFrame, layout: Layout, *key: str) -> DataFrame:
    """Add the row's unit, from a hash of its key columns."""
    return df.withColumn("unit", F.pmod(F.xxhash64(*key), F.lit(layout.units)).cast("int"))


@dataclass(frozen=True)
class Keys:
    """The distinct keys of a unit, ordered by bucket and key."""

    keys: np.ndarray
    place: np.ndarray  # of every given entry, its place among `keys`
    buckets: np.ndarray

    @staticmethod
    def of(keys: np.ndarray, second: np.ndarray, layout: Layout) -> Keys:
        found, first, place = np.unique(keys, return_index=True, return_inverse=True)
        buckets = (second[first] % np.uint64(layout.buckets)).astype(np.int32)
        order = np.argsort(buckets, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        return Keys(found[order], rank[place], buckets[order])

    def summed(self, weights: np.ndarray | None = None) -> np.ndarray:
        """Weights (1 each if none) added up per distinct key."""
        return np.bincount(self.place, weights, minlength=len(self.keys)).astype(np.int64)

    def blobs(self, unit: int, counts: np.ndarray) -> pa.Table:
        """One row per bucket that has keys."""
        edges = np.flatnonzero(np.diff(self.buckets, prepend=-1, append=-1)) if len(self.keys) else np.zeros(1, np.int64)
        pairs = list(zip(edges[:-1], edges[1:]))
        return pa.table({
            "unit": pa.array(np.full(len(pairs), unit, np.int32)),
            "bucket": pa.array(self.buckets[edges[:-1]].astype(np.int32) if pairs else np.zeros(0, np.int32)),
            "keys": pa.array([self.keys[a:b].tobytes() for a, b in pairs], pa.binary()),
            "counts": pa.array([packed(counts[a:b]) for a, b in pairs], pa.binary()),
        }, schema=_BLOBS)

    def totals(self, rows: pa.Table) -> np.ndarray:
        """The returned totals, in the order of `keys`."""
        order = np.argsort(rows.column("bucket").to_numpy())
        parts = rows.column("totals").to_pylist()
        if not parts:
            return np.zeros(len(self.keys), np.int64)
        width = sum(map(len, parts)) // max(len(self.keys), 1)
        return np.frombuffer(b"".join([parts[i] for i in order]), {1: np.uint8, 8: np.int64}[width])


def squeezed(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(values.tobytes())


def released(blob: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(blob)


def packed(values: np.ndarray) -> bytes:
    """Whole numbers from 0: a byte each, larger ones again in full, compressed."""
    small = np.minimum(values, 255).astype(np.uint8)
    return squeezed(np.append(small, values[values >= 255].astype(np.int64).view(np.uint8)))


def unpacked(blob: bytes, n: int) -> np.ndarray:
    data = np.frombuffer(released(blob), np.uint8)
    out = data[:n].astype(np.int64)
    out[out == 255] = data[n:].copy().view(np.int64)
    return out


def numbers(column: Iterable[bytes], sizes: Iterable[int]) -> np.ndarray:
    """The packed numbers of all blobs, one after another."""
    return np.concatenate([unpacked(b, n) for b, n in zip(column, sizes)])


def exact(totals: np.ndarray) -> np.ndarray:
    return totals.astype(np.int64)


def magnitude(totals: np.ndarray) -> np.ndarray:
    """0 for none, 1 for one, 2 for two or three, 3 for four to seven, and so on."""
    return np.ceil(np.log2(totals + 1.0)).astype(np.uint8)


def _add_up(encode, summary, table: pa.Table) -> pa.Table:
    blobs = table.column("keys").to_pylist()
    sizes = np.array([len(b) // 8 for b in blobs])
    keys = np.frombuffer(b"".join(blobs), np.uint64)
    counts = numbers(table.column("counts").to_pylist(), sizes)
    order = np.argsort(keys)
    ordered = keys[order]
    new = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(keys) else np.zeros(0, np.int64)
    sums = np.add.reduceat(counts[order], new, dtype=np.int64) if len(keys) else counts
    totals = np.empty(len(keys), np.int64)
    totals[order] = np.repeat(sums, np.diff(np.append(new, len(keys))))
    out = encode(totals)
    edges = np.concatenate([[0], np.cumsum(sizes)])
    units = table.column("unit").to_pylist()
    buckets = table.column("bucket").to_pylist()
    values = [out[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:])]
    if summary is not None:
        units.append(-1)
        buckets.append(buckets[0])
        values.append(summary(sums))
    return pa.table({"unit": pa.array(units, pa.int32()), "bucket": pa.array(buckets, pa.int32()), "totals": pa.array(values, pa.binary())}, schema=_TOTALS)


def add_up(blobs: DataFrame, encode: Callable[[np.ndarray], np.ndarray], summary: Callable[[np.ndarray], bytes] | None = None) -> DataFrame:
    """Totals of every key over all units, back in each unit's order.  `encode` picks
    the width; `summary` of a bucket's distinct totals goes to rows of unit -1."""

    def add(table: pa.Table) -> pa.Table:
        return _add_up(encode, summary, table)

    return blobs.groupBy("bucket").applyInArrow(add, TOTALS)
