"""Packing of token pieces into sequences of fixed room by minimum bin slack.

Pieces of one length are alike, so a plan needs only how many there are of each
length: at most `room` numbers, whatever the corpus.  For each bin a subset-sum
program over the lengths that are left, its reachable sums held as bits of one whole
number, finds the fullest combination; of equally full ones the one with the longest
pieces.  The combination is taken out as often as the counts allow, which is what
taking it bin by bin would do, as it stays the fullest until a length runs short.

Spark writes the pieces with a running number per task and length; sums of the counts
before a task make that a rank, and the rank says which bin of which combination a
piece goes to.  No window runs over pieces, and no length is gathered in one task.

A null text is an empty one and gives one piece, the end mark alone; ids may be null
or repeat, each row is packed on its own; other columns are left out.  An empty table
gives an empty result."""

from __future__ import annotations

import base64
import os
import re
import zlib
from collections import Counter
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window as W, functions as F, types as T

from tabulyte.llm.scratch import kept

ROOM = 2048
END = 0
#: Characters of a text encoded at once.
STRETCH = 1 << 20

#: How the byte-level vocabulary splits a text, and code points whose class
#: has never changed between versions of Unicode.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
UNSETTLED = re.compile("[^\u0000-\u024f\u0400-\u045f\u2010-\u2027\u20ac\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5]")
#: Where every version of the split ends a token: before a single space between two words.
SEAM = re.compile(r"(?<=\S) (?=\S)")


class Encoder:
    """Token ids of texts as little-endian bytes.  Strings of control tokens are ordinary
    text.

    The vocabulary stands in two files, `<stem>.json` and, as ranks, `<stem>.tiktoken`.
    The ranks give the same ids several times faster and serve texts whose code points no
    two versions of Unicode class differently; the rest goes by the first file."""

    def __init__(self, stem: str | None = None):
        import tiktoken
        from tokenizers import Tokenizer

        if stem is None:
            import public_tokenizers

            stem = public_tokenizers.path("byte_bpe_50k.json").removesuffix(".json")
        self.whole = Tokenizer.from_file(f"{stem}.json")
        self.whole.encode_special_tokens = True
        with open(f"{stem}.tiktoken", "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.quick = tiktoken.Encoding(os.path.basename(stem), pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def _stretch(self, text: str) -> list[int]:
        if UNSETTLED.search(text):
            return self.whole.encode_batch_fast([text], add_special_tokens=False)[0].ids
        return self.quick.encode_ordinary(text)

    def ids(self, text: str | None) -> bytes:
        """The ids of the text and the end mark."""
        out, at, text = [], 0, text or ""
        while len(text) - at > STRETCH:
            seam = SEAM.search(text, at + STRETCH)
            if not seam:
                break
            out += self._stretch(text[at : seam.start()])
            at = seam.start()
        if at < len(text):
            out += self._stretch(text[at:])
        out.append(END)
        return np.array(out, "<u4").tobytes()


def cut(total: int, room: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of `total` ids; the first may be shorter."""
    first = total % room or room
    return [(0, min(first, total)), *[(at, room) for at in range(first, total, room)]]


@dataclass(frozen=True)
class Combination:
    """Pieces of one bin, (length, copies) from the longest down, and how many bins hold it."""

    parts: tuple[tuple[int, int], ...]
    bins: int


class _Sums:
    """Sums that the shorter lengths reach, kept from bin to bin: only those of lengths
    from the first whose usable copies have changed are made again."""

    def __init__(self, room: int, left: Mapping[int, int]):
        self.room, self.left = room, dict(left)
        self.lengths = sorted(left)
        self.usable = [min(left[x], room // x) for x in self.lengths]
        self.below = [1]  # below[i]: sums of the lengths before the i-th
        self.bits = (1 << (room + 1)) - 1

    def _extend(self, to: int) -> None:
        while len(self.below) <= to:
            i = len(self.below) - 1
            reach, copies, step = self.below[i], self.usable[i], 1
            while copies:
                step = min(step, copies)
                reach |= (reach << (step * self.lengths[i])) & self.bits
                copies, step = copies - step, 2 * step
            self.below.append(reach)

    def fullest(self, seeded: bool) -> tuple[tuple[int, int], ...]:
        """The fullest combination; `seeded` ones hold the longest length that is left."""
        while not self.usable[-1]:
            self.lengths.pop()
            self.usable.pop()
        del self.below[len(self.lengths) :]
        last = len(self.lengths) - 1
        self._extend(last)
        longest, best, copies = self.lengths[last], -1, 0
        for c in range(int(seeded), self.usable[last] + 1):
            under = self.below[last] & ((1 << (self.room - c * longest + 1)) - 1)
            if c * longest + under.bit_length() - 1 >= best:
                best, copies = c * longest + under.bit_length() - 1, c
        parts, rest = [(longest, copies)], best - copies * longest
        for i in range(last - 1, -1, -1):
            if not rest:
                break
            c = min(self.usable[i], rest // self.lengths[i])
            while not self.below[i] >> (rest - c * self.lengths[i]) & 1:
                c -= 1
            parts.append((self.lengths[i], c))
            rest -= c * self.lengths[i]
        return tuple(p for p in parts if p[1])

    def take(self, parts: tuple[tuple[int, int], ...]) -> int:
        """Take the combination out as often as it goes; the number of bins."""
        bins = min(self.left[x] // c for x, c in parts)
        place = {x: i for i, x in enumerate(self.lengths)}
        for x, c in parts:
            self.left[x] -= c * bins
            i, now = place[x], min(self.left[x], self.room // x)
            if now != self.usable[i]:
                self.usable[i] = now
                del self.below[i + 1 :]
        return bins


def minimum_bin_slack(counts: Mapping[int, int], room: int = ROOM, seeded: bool | None = None) -> list[Combination]:
    """Combinations that use up `counts` pieces of each length.  With `seeded` each bin
    holds the longest piece left; by default both ways are tried and the fewer bins win."""
    if seeded is None:
        plans = [minimum_bin_slack(counts, room, way) for way in (True, False)]
        return min(plans, key=lambda p: sum(c.bins for c in p))
    sums = _Sums(room, {x: n for x, n in counts.items() if n > 0})
    out = []
    while any(sums.usable):
        parts = sums.fullest(seeded)
        out.append(Combination(parts, sums.take(parts)))
    return out


class _Places:
    """Where the pieces of a length go by their rank: arrays over the plan, per length."""

    def __init__(self, plan: list[Combination]):
        rows: dict[int, list[tuple[int, int, int, int]]] = {}
        ranks: Counter[int] = Counter()
        sequence = 0
        for c in plan:
            offset = 0
            for length, copies in c.parts:
                rows.setdefault(length, []).append((ranks[length], copies, sequence, offset))
                ranks[length] += copies * c.bins
                offset += length * copies
            sequence += c.bins
        self.rows = {x: np.array(r, np.int64).T for x, r in rows.items()}

    def of(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of each piece."""
        sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
        order = np.argsort(length, kind="stable")
        found, first = np.unique(length[order], return_index=True)
        for x, rows in zip(found.tolist(), np.split(order, first[1:])):
            start, copies, bin_, at = self.rows[x]
            i = np.searchsorted(start, rank[rows], side="right") - 1
            bins, nth = np.divmod(rank[rows] - start[i], copies[i])
            sequence[rows], offset[rows] = bin_[i] + bins, at[i] + nth * x
        return sequence, offset


def _pieces(id_type: T.DataType, id_col: str, text: str, room: int, stem: str | None, with_ids: bool):
    out = T.StructType([
        T.StructField("unit", T.IntegerType()), T.StructField("nth", T.LongType()), T.StructField(id_col, id_type), T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()), T.StructField("length", T.IntegerType()), T.StructField("ids_crc32", T.LongType()),
        *([T.StructField("ids", T.BinaryType())] if with_ids else []),
    ])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, seen, unit = Encoder(stem), Counter(), TaskContext.get().partitionId()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                row, cols = [], [[] for _ in range(6)]
                for i, t in enumerate(part.column(1).to_pylist()):
                    ids = encoder.ids(t)
                    for k, (start, length) in enumerate(cut(len(ids) // 4, room)):
                        held = ids[4 * start : 4 * (start + length)]
                        row.append(i)
                        for c, v in zip(cols, (seen[length], k, start, length, zlib.crc32(held), held)):
                            c.append(v)
                        seen[length] += 1
                nth, piece, start, length, crc, held = cols
                ids_of = part.column(0).take(pa.array(row, pa.int32()))
                arrays = [pa.array([unit] * len(row), pa.int32()), pa.array(nth, pa.int64()), ids_of, pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                          pa.array(length, pa.int32()), pa.array(crc, pa.int64()), *([pa.array(held, pa.binary())] if with_ids else [])]
                yield pa.RecordBatch.from_arrays(arrays, out.names)

    return encode, out


def pack(docs: DataFrame, id_col: str = "doc_id", text: str = "text", room: int = ROOM, vocabulary: str | None = None, with_ids: bool = False) -> DataFrame:
    """The pieces of all texts and their places: the id, `piece`, `start`, `length`,
    `ids_crc32`, `sequence_id` (from 0, without gaps) and `offset`; `with_ids` adds the
    token ids, little-endian 32-bit.  `vocabulary` is the path of the vocabulary's files on
    the executors, without their endings.  Documents of more than `room` tokens are cut."""
    encode, schema = _pieces(docs.schema[id_col].dataType, id_col, text, room, vocabulary, with_ids)
    pieces = kept(docs.select(id_col, text).mapInArrow(encode, schema), "pieces")
    counts = pieces.groupBy("unit", "length").agg(F.count(F.lit(1)).alias("n"))
    total = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `room` rows
    places = docs.sparkSession.sparkContext.broadcast(_Places(minimum_bin_slack(total, room)))
    earlier = W.partitionBy("length").orderBy("unit").rowsBetween(W.unboundedPreceding, -1)
    before = counts.select(F.col("unit").alias("_u"), F.col("length").alias("_l"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_before"))
    ranked = pieces.join(before, (F.col("unit") == F.col("_u")) & (F.col("length") == F.col("_l")))
    result = T.StructType([*schema.fields[2:], T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    names = [f.name for f in schema.fields[2:]]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rank = b.column("_rank").to_numpy(zero_copy_only=False)
            sequence, offset = places.value.of(b.column("length").to_numpy(zero_copy_only=False), rank)
            yield pa.RecordBatch.from_arrays([*[b.column(n) for n in names], pa.array(sequence), pa.array(offset)], result.names)

    return ranked.select(*names, (F.col("nth") + F.col("_before")).alias("_rank")).mapInArrow(place, result)
