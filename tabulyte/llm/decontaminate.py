"""Benchmark decontamination with a generalised suffix automaton.

The automaton holds every run of words of the benchmark items.  A document's words
stream through it; the longest match that ends at each word shows which item windows
end there.  Items are dealt to blocks of bounded size, one automaton each, so what is
broadcast does not grow with the benchmark; documents pass the blocks in turn."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tabulyte.llm import words
from tabulyte.llm.scratch import kept

WINDOW = 10
#: Words of one automaton; a block may exceed it a little as items are dealt by hash.
BLOCK_WORDS = 50_000
PIECE_WORDS = 5_000

_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
#: Lower case for word bytes, a blank for all others.
_PLAIN = bytes(b if _ALNUM[b] else 0x20 for b in words.LOWER.tolist())


def normalised(text: str | None) -> list[bytes]:
    return text.encode().translate(_PLAIN).split() if text else []


class Automaton:
    """Suffix automaton of several word sequences.

    Items of fewer than `window` words count as one window each."""

    def __init__(self, items: Iterable[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window, self.names, self.ids = window, [], {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        coded = []
        for name, found in items:
            if found:
                self.names.append(name)
                coded.append([self.ids.setdefault(w, len(self.ids)) for w in found])
        for item in coded:
            state = 0
            for word in item:
                state = self._extend(state, word)
        self.holds: dict[int, list[int]] = {}
        self.whole: dict[int, list[int]] = {}
        for k, item in enumerate(coded):
            self._enter(k, item)
        self.shorter = self._nearest_whole()
        self.least = min((min(len(x), window) for x in coded), default=0)

    def _state(self, length: int, follow: dict[int, int], link: int) -> int:
        self.next.append(follow)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _split(self, state: int, word: int, into: int) -> int:
        """The state of exactly the strings one word longer than those of `state`."""
        if self.length[into] == self.length[state] + 1:
            return into
        twin = self._state(self.length[state] + 1, dict(self.next[into]), self.link[into])
        self.link[into] = twin
        while state >= 0 and self.next[state].get(word) == into:
            self.next[state][word] = twin
            state = self.link[state]
        return twin

    def _extend(self, last: int, word: int) -> int:
        known = self.next[last].get(word)
        if known is not None:
            return self._split(last, word, known)
        new = self._state(self.length[last] + 1, {}, 0)
        at = last
        while at >= 0 and word not in self.next[at]:
            self.next[at][word] = new
            at = self.link[at]
        if at >= 0:
            self.link[new] = self._split(at, word, self.next[at][word])
        return new

    def _enter(self, item: int, coded: list[int]) -> None:
        """Note the item on every state of at least `window` words that it contains."""
        state = 0
        for word in coded:
            state = self.next[state][word]
            up = state
            while self.length[up] >= self.window and self.holds.get(up, [-1])[-1] != item:
                self.holds.setdefault(up, []).append(item)
                up = self.link[up]
        if len(coded) < self.window:
            self.whole.setdefault(state, []).append(item)

    def _nearest_whole(self) -> list[int]:
        """For each state, the longest of its suffix states that is a whole short item."""
        near = [-1] * len(self.next)
        if self.whole:
            for state in sorted(range(1, len(near)), key=self.length.__getitem__):
                near[state] = state if state in self.whole else near[self.link[state]]
        return near

    def scan(self, coded: list[int], base: int, spans: list[tuple[int, int]], items: set[int]) -> None:
        """Stream known words; add hit intervals (positions from `base`) and items."""
        state = size = 0
        follow, link, length, window = self.next, self.link, self.length, self.window
        for i, word in enumerate(coded, base + 1):
            while word not in follow[state] and state:
                state = link[state]
                size = length[state]
            if word not in follow[state]:
                continue
            state = follow[state][word]
            size += 1
            if size >= window:
                spans.append((i - size, i))
                up = state
                while length[link[up]] >= window:
                    up = link[up]
                items.update(self.holds[up])
            part = self.shorter[state]
            while part > 0:
                if length[part] <= size:
                    spans.append((i - length[part], i))
                    items.update(self.whole[part])
                part = self.shorter[link[part]]

    def hits(self, found: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Hit word intervals and items of one text."""
        spans: list[tuple[int, int]] = []
        items: set[int] = set()
        if len(found) < self.least or not self.least:
            return spans, items
        coded = np.fromiter(map(self.ids.get, found, repeat(-1)), np.int64, len(found))
        edges = np.flatnonzero(np.diff(coded >= 0, prepend=False, append=False))
        for a, b in zip(edges[::2], edges[1::2]):
            if b - a >= self.least:
                self.scan(coded[a:b].tolist(), int(a), spans, items)
        return spans, items


def merged(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _pieces(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Items as normalised words, long ones as pieces that overlap by a window less one word."""
    for batch in batches:
        names, texts = [], []
        for name, text in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist()):
            found = normalised(text)
            for a in range(0, max(len(found) - window + 1, 1 if found else 0), PIECE_WORDS):
                names.append(name)
                texts.append(b" ".join(found[a : a + PIECE_WORDS + window - 1]).decode())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(texts, pa.string())], ["item", "text"])


def _scanned(docs: DataFrame, benchmark: DataFrame, window: int, names: tuple[str, str, str, str], carry: Sequence[str], finish, fields: str) -> DataFrame:
    """Documents passed through all automata; `finish` makes the result of a batch from
    its columns row, text, n_words, spans and items, in the task that found them."""
    id_col, text_col, item_col, item_text_col = names
    spark = docs.sparkSession
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), F.col(item_text_col).alias("text"))

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _pieces(batches, window)

    items = kept(items.mapInArrow(pieces, "item string, text string").distinct(), "items")  # copies of an item are one
    n_words = items.agg(F.sum(F.length("text") - F.length(F.translate("text", " ", "")) + 1)).first()[0] or 0
    blocks = max(1, -(-n_words // BLOCK_WORDS))
    items = items.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(blocks)))
    rest = [F.struct(*[F.col(f"`{c}`") for c in carry]).alias("rest")] if carry else []
    row = F.struct(F.col(id_col).alias("doc_id"), *rest)
    out = docs.select(row.alias("row"), F.col(text_col).alias("text"))
    kind = out.schema["row"].dataType.simpleString()
    found = "spans array<struct<start: long, end: long>>, items array<string>"
    out = out.withColumn("spans", F.array().cast("array<struct<start: long, end: long>>")).withColumn("items", F.array().cast("array<string>"))
    for block in range(blocks):
        rows = items.filter(F.col("block") == block).select("item", "text").collect()  # BLOCK_WORDS words or so
        shared = spark.sparkContext.broadcast(Automaton(((r.item, r.text.encode().split()) for r in rows), window))
        last = block + 1 == blocks

        def scan(batches: Iterator[pa.RecordBatch], shared=shared, last=last) -> Iterator[pa.RecordBatch]:
            automaton = shared.value
            for batch in batches:
                sizes, spans, known = [], [], []
                old = zip(batch.column("text"), batch.column("spans").to_pylist(), batch.column("items").to_pylist())
                for text, before, items in old:
                    ws = normalised(text.as_py())
                    hit, more = automaton.hits(ws)
                    sizes.append(len(ws))
                    spans.append(merged([*((x["start"], x["end"]) for x in before), *hit]) if before or hit else [])
                    known.append(sorted({*items, *(automaton.names[k] for k in more)}) if items or more else [])
                if last:
                    yield finish(batch.column("row"), batch.column("text"), sizes, spans, known)
                else:
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("row"), batch.column("text"), _span_column(spans), pa.array(known, pa.list_(pa.string()))], ["row", "text", "spans", "items"])

        out = out.mapInArrow(scan, f"row {kind}, {fields}" if last else f"row {kind}, text string, {found}")
        if not last:
            out = kept(out, "matched")
    return out


def _span_column(spans: list[list[tuple[int, int]]]) -> pa.Array:
    return pa.array([[{"start": a, "end": b} for a, b in s] for s in spans], _SPANS)


def matched(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
            item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, spans (hit word intervals, end exclusive,
    merged, in order) and items (ids of items with a window in the text, as strings,
    sorted, distinct).

    Words are runs of lower-cased letters, digits and non-ASCII characters.  A window is
    `window` consecutive item words, or all of a shorter item.  Null or empty texts have
    no words; items without words match nothing; a null item id is the string ''.  Equal
    ids of several items are one item in `items`.  An empty benchmark hits nothing.
    Repeated rows are returned as often.  Columns not named are ignored."""

    def finish(row, text, sizes, spans, items):
        return pa.RecordBatch.from_arrays(
            [row, pa.array(sizes, pa.int64()), _span_column(spans), pa.array(items, pa.list_(pa.string()))], ["row", "n_words", "spans", "items"])

    fields = "n_words long, spans array<struct<start: long, end: long>>, items array<string>"
    out = _scanned(docs, benchmark, window, (id_col, text_col, item_col, item_text_col), (), finish, fields)
    return out.select("row.doc_id", "n_words", "spans", "items")


def without(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the intervals and what follows each up to the next word."""
    data = np.frombuffer(text.encode(), np.uint8)
    begin, _ = words.word_spans(words.LOWER[data], np.array([0, len(data)]), _ALNUM)
    begin = np.append(begin, len(data))
    keep = np.ones(len(data), bool)
    for a, b in spans:
        keep[begin[a] : begin[b]] = False
    return data[keep].tobytes().decode()


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, min_span: int = WINDOW, max_coverage: float = 0.5,
                  id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The input's columns for the documents left: spans of at least `min_span` words
    and whole items shorter than a window are cut out of the text, and a document with more than `max_coverage` of its words hit goes.
    Other texts stay byte for byte, null texts null.  Columns pass through whatever their
    names; the cases of `matched` hold."""
    others = [c for c in docs.columns if c not in (id_col, text_col)]

    def finish(row, text, sizes, spans, items):
        stay, texts = [], []
        for i, (n, found) in enumerate(zip(sizes, spans)):
            if sum(b - a for a, b in found) <= max_coverage * n:
                cut = [(a, b) for a, b in found if b - a >= min_span or b - a < window]
                stay.append(i)
                texts.append(without(text[i].as_py(), cut) if cut else text[i].as_py())
        return pa.RecordBatch.from_arrays([row.take(pa.array(stay, pa.int64())), pa.array(texts, pa.string())], ["row", "text"])

    out = _scanned(docs, benchmark, window, (id_col, text_col, item_col, item_text_col), others, finish, "text string")
    place = {id_col: F.col("row.doc_id"), text_col: F.col("text")}
    return out.select(*[(place[c] if c in place else F.col(f"row.rest.`{c}`")).alias(c) for c in docs.columns])
