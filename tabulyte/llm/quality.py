"""Quality rules: counts of a text, and compression bands.

Zstandard ratios (bytes before by bytes after) of the whole text and of chunks of it
must lie in a band that depends on the length: text that says the same again in other
words or numbers compresses too well, random or encoded characters too little.  The
chunks cover the whole text; the last takes what is left over, and a short text is one."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from tabulyte.llm import words

LEVEL = 3
CHUNK = 4096
#: Up to so many bytes: least and greatest ratio.  Measured on texts labelled good that
#: pass the base rules: about 8% below their least ratio and 10% above their greatest, at
#: each length; longer texts compress better, as more of them has been seen before.
BANDS: tuple[tuple[float, float, float], ...] = (
    (256, 1.0, 2.3),
    (512, 1.2, 2.1),
    (1024, 1.3, 2.22),
    (2048, 1.5, 2.38),
    (4096, 1.65, 2.46),
    (8192, 1.8, 2.58),
    (16384, 1.95, 2.67),
    (65536, 2.05, 2.85),
    (float("inf"), 2.1, 3.2),
)
#: A text goes if more than this share of its chunks is outside the band of a chunk.
CHUNK_SHARE = 0.5
MIN_WORDS, REPEAT_PERCENT = 50, 50

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_SLICE = 2 << 20
_FIELDS = [("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()),
           ("base_failed", pa.bool_()), ("ratio", pa.float64()), ("chunks_outside", pa.int64()), ("n_chunks", pa.int64()), ("kept", pa.bool_())]


def band(size: int, bands: Sequence[tuple[float, float, float]] = BANDS) -> tuple[float, float]:
    return next((lo, hi) for most, lo, hi in bands if size <= most)


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return np.diff(sums[offsets])


def _repeat_words(data: np.ndarray, begin: np.ndarray, end: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Words in 3-word windows that a text holds twice or more, per text."""
    first, keys, _ = words.windows(words.word_hashes(data, begin, end), bounds, 3)
    text = np.searchsorted(bounds, first, side="right") - 1
    own = words.mix(keys + text.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93), 5)
    _, place, counts = np.unique(own, return_inverse=True, return_counts=True)
    hit = np.zeros(len(begin) + 3, bool)
    twice = first[counts[place] > 1] if len(first) else first
    for k in range(3):
        hit[twice + k] = True
    return _per_text(hit[: len(begin)], bounds)


def _dup_lines(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    return len(lines) - len(set(lines))


def chunks_of(size: int, chunk: int) -> list[tuple[int, int]]:
    """First and end byte of every chunk: at least one, the last with the rest."""
    count = max(1, size // chunk)
    return [(k * chunk, (k + 1) * chunk if k + 1 < count else size) for k in range(count)]


def _compression(text: bytes, pack: zstandard.ZstdCompressor, chunk: int, bands) -> tuple[float, int, int]:
    if not text:
        return 0.0, 0, 0
    ratio = len(text) / len(pack.compress(text))
    parts = chunks_of(len(text), chunk)
    outside = 0
    for a, b in parts:
        lo, hi = band(b - a, bands)
        outside += not lo <= (ratio if len(parts) == 1 else (b - a) / len(pack.compress(text[a:b]))) <= hi
    return ratio, outside, len(parts)


def _rows(column: pa.Array, settings: dict) -> dict[str, np.ndarray | list]:
    data, offsets = words.text_bytes(column)
    begin, end = words.word_spans(data, offsets)
    bounds = words.text_of(begin, offsets)
    n_words = np.diff(bounds)
    points = (data & 0xC0) != 0x80
    repeats = _repeat_words(data, begin, end, bounds)
    pack = zstandard.ZstdCompressor(level=settings["level"])
    raw = data.tobytes()
    texts = [raw[a:b] for a, b in zip(offsets[:-1], offsets[1:])]
    ratio, outside, chunks = zip(*[_compression(t, pack, settings["chunk"], settings["bands"]) for t in texts]) if texts else ((), (), ())
    failed = (n_words < settings["min_words"]) | (100 * repeats > settings["repeat_percent"] * n_words)
    limits = [band(len(t), settings["bands"]) for t in texts]
    fine = np.array([lo <= r <= hi and o <= settings["chunk_share"] * c for (lo, hi), r, o, c in zip(limits, ratio, outside, chunks)], bool)
    values = [n_words, _per_text(words.SPACED[data] & points, offsets), _per_text(_SYMBOL[data], offsets),
              [_dup_lines(t) for t in texts], repeats, failed, ratio, outside, chunks, ~failed & fine]
    return {name: pa.array(v, kind) for (name, kind), v in zip(_FIELDS, values)}


def quality(docs: DataFrame, text_col: str = "text", report: str = "quality", *, carry: Sequence[str] | None = None, bands=BANDS, level: int = LEVEL, chunk: int = CHUNK,
            chunk_share: float = CHUNK_SHARE, min_words: int = MIN_WORDS, repeat_percent: int = REPEAT_PERCENT) -> DataFrame:
    """The columns `carry` (all of the input's if none are named) and `report`, a struct of n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, base_failed, ratio, chunks_outside, n_chunks, kept.

    A null or empty text has all counts 0, ratio 0, and fails as too short.  A text is
    kept if the base rules pass, its ratio is in the band of its length in bytes, and at
    most `chunk_share` of its chunks are outside the band of their length.  Each row is judged by itself, so repeated rows agree; other
    columns pass through, one named like `report` is replaced."""
    settings = {"bands": bands, "level": level, "chunk": chunk, "chunk_share": chunk_share, "min_words": min_words, "repeat_percent": repeat_percent}
    names = [c for c in (docs.columns if carry is None else carry) if c != report]
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), *[F.col(text_col).alias("text")] * (text_col not in names))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("row")
            column = rows.field(text_col) if text_col in names else batch.column("text")
            sizes = np.concatenate([[0], np.cumsum(words.text_sizes(column))])
            at = 0
            while at < batch.num_rows:  # by size, so that long texts do not add up
                to = max(at + 1, int(np.searchsorted(sizes, sizes[at] + _SLICE, side="right")) - 1)
                found = _rows(column.slice(at, to - at), settings)
                found = pa.StructArray.from_arrays(list(found.values()), names=list(found))
                yield pa.RecordBatch.from_arrays([rows.slice(at, to - at), found], ["row", "found"])
                at = to

    kind = held.schema["row"].dataType.simpleString()
    fields = "n_words: long, word_chars: long, n_symbols: long, n_dup_lines: long, n_repeat_words: long, base_failed: boolean, ratio: double, chunks_outside: long, n_chunks: long, kept: boolean"
    out = held.mapInArrow(judge, f"row {kind}, found struct<{fields}>")
    return out.select(*[F.col(f"row.`{c}`").alias(c) for c in names], F.col("found").alias(report))
