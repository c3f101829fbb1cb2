"""Exact substring deduplication: repeated fixed-length word windows are removed.

Every window of `width` words gets a Rabin-Karp hash; Spark adds up, per hash, the
windows of the whole corpus (`tally`), and repeated windows merge into maximal
removal intervals."""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tabulyte.llm import tally, words
from tabulyte.llm.scratch import kept

WIDTH = 35


def _unit(width: int, layout: tally.Layout, table: pa.Table):
    data, offsets = words.text_bytes(table.column("text"))
    begin, end = words.word_spans(data, offsets)
    bounds = words.text_of(begin, offsets)
    first, keys, second = words.windows(words.word_hashes(data, begin, end), bounds, width)
    return data, offsets, bounds, first, tally.Keys.of(keys, second, layout)


def _send(width: int, layout: tally.Layout, table: pa.Table) -> pa.Table:
    *_, keys = _unit(width, layout, table)
    return keys.blobs(table.column("unit")[0].as_py(), np.minimum(keys.summed(), 2))


def _cut(width: int, layout: tally.Layout, table: pa.Table, totals: pa.Table) -> pa.Table:
    data, offsets, bounds, first, keys = _unit(width, layout, table)
    repeated = first[keys.totals(totals)[keys.place] >= 2] if len(first) else first
    n = int(bounds[-1])
    cover = np.zeros(n + 1, np.int64)
    np.add.at(cover, repeated, 1)
    np.add.at(cover, repeated + width, -1)
    removed = np.cumsum(cover[:n]) > 0
    edge = np.flatnonzero(np.diff(removed.astype(np.int8), prepend=0, append=0))
    starts, ends = edge[::2], edge[1::2]
    # an interval that runs from one text into the next is two intervals
    inner = bounds[1:-1]
    inner = inner[(inner > 0) & (inner < n)]
    inner = np.unique(inner[removed[inner - 1] & removed[inner]]) if n else inner
    starts, ends = np.sort(np.append(starts, inner)), np.sort(np.append(ends, inner))
    at = np.searchsorted(starts, bounds)
    gone = np.concatenate([[0], np.cumsum(removed)])[bounds]
    texts, spans = [], []
    for i in range(table.num_rows):
        a, b = bounds[i], bounds[i + 1]
        found = data[offsets[i] : offsets[i + 1]].tobytes().split()
        if gone[i + 1] > gone[i]:
            found = compress(found, (~removed[a:b]).tolist())
        texts.append(b" ".join(found))
        spans.append([{"start": int(s - a), "end": int(e - a)} for s, e in zip(starts[at[i] : at[i + 1]], ends[at[i] : at[i + 1]])])
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    return pa.table({
        "doc_id": table.column("doc_id"),
        "n_words": pa.array(np.diff(bounds), pa.int64()),
        "n_removed": pa.array(np.diff(gone), pa.int64()),
        "kept_text": pa.array(texts, pa.binary()).cast(pa.string()),
        "removed": pa.array(spans, span),
    })


def substring_dedup(docs: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_text (kept words joined
    by one space) and removed (word intervals, end exclusive, maximal, in order).

    A word goes if a window over it starts with the same words anywhere else, in
    this document or another; windows are judged on the input.  A null or empty text
    has no words, kept_text '' and no intervals.  Texts shorter than `width` stay whole.
    Repeated rows count as separate occurrences, so copies lose all their words; each
    row is returned.  Columns other than the id and the text are ignored."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    layout = tally.Layout.of(docs)
    units = tally.in_units(docs, layout, "doc_id", "text")

    def send(table: pa.Table) -> pa.Table:
        return _send(width, layout, table)

    def cut(table: pa.Table, totals: pa.Table) -> pa.Table:
        return _cut(width, layout, table, totals)

    sent = units.select("unit", "text").groupBy("unit").applyInArrow(send, tally.BLOBS)
    totals = kept(tally.add_up(sent, tally.magnitude), "windows")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return (
        units.groupBy("unit").cogroup(totals.groupBy("unit"))
        .applyInArrow(cut, f"doc_id {kind}, n_words long, n_removed long, kept_text string, removed array<struct<start: long, end: long>>")
    )
