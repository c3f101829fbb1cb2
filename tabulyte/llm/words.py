"""Words of a whole Arrow string column at once, as byte spans and 64-bit hashes.

Texts stay UTF-8 bytes: every separator in use is ASCII, and no byte of a longer
code point is, so splitting bytes gives the same words as splitting characters."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Word bytes of `[^\x20\x09-\x0D]+`.
SPACED = np.ones(256, bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False

#: Maps A-Z to a-z and leaves all other bytes.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_U = np.uint64
_SLICE = 1 << 20


def mix(h: np.ndarray, salt: int = 0) -> np.ndarray:
    """Bijective scrambling of 64-bit values (the splitmix64 finaliser)."""
    h = h + _U((0x9E3779B97F4A7C15 * (salt + 1)) & 0xFFFFFFFFFFFFFFFF)
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


_BYTE = mix(np.arange(256, dtype=_U), 7)


class _Powers:
    """Powers of an odd base modulo 2**64 and of its inverse."""

    def __init__(self, base: int):
        self.base, self.inverse = _U(base), _U(pow(base, -1, 1 << 64))
        self.up = self.down = np.ones(1, _U)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            for name, b in (("up", self.base), ("down", self.inverse)):
                steps = np.full(size, b, _U)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=_U))
        return self.up[:n], self.down[:n]


_IN_WORD = _Powers(0xA0761D6478BD642F)
_IN_WINDOW = (_Powers(0xE7037ED1A0B428DB), _Powers(0x8EBC6AF09C88C6E3))


def text_bytes(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after another and the n + 1 offsets of the texts;
    a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if isinstance(column, pa.ChunkedArray):  # combining gives chunks again beyond 2 GB
        column = pa.concat_arrays([c.cast(pa.large_string()) for c in column.chunks])
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if column.null_count:
        sizes = np.where(column.is_valid().to_numpy(zero_copy_only=False), np.diff(offsets), 0)
        if sizes.sum() != offsets[-1] - offsets[0]:
            column = column.fill_null("")
            return text_bytes(column)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def text_sizes(column: pa.Array) -> np.ndarray:
    """Bytes of each text; a null has none."""
    return pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def word_spans(data: np.ndarray, offsets: np.ndarray, word_bytes: np.ndarray = SPACED) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end byte of every word, in order; no word crosses two texts."""
    inside = word_bytes[data]
    n = len(inside)
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1] | cut[1:n]
    end[:-1] &= ~inside[1:] | cut[1:n]
    return np.flatnonzero(begin), np.flatnonzero(end) + 1


def text_of(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For every text, how many words start before it: n + 1 bounds into `starts`."""
    return np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes, from prefix sums over slices of the bytes."""
    out = np.empty(len(begin), _U)
    at = 0
    while at < len(begin):
        lo = int(begin[at])
        to = max(at + 1, int(np.searchsorted(end, lo + _SLICE, side="right")))
        hi = int(end[to - 1])
        up, down = _IN_WORD.to(hi - lo + 1)
        sums = np.zeros(hi - lo + 1, _U)
        np.cumsum(_BYTE[data[lo:hi]] * up[: hi - lo], out=sums[1:])
        b, e = begin[at:to] - lo, end[at:to] - lo
        out[at:to] = (sums[e] - sums[b]) * down[b]
        at = to
    return mix(out + (end - begin).astype(_U))


def windows(hashes: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rabin-Karp hashes of all `width` consecutive words inside one text: the
    first word of each window, its key, and a second independent hash."""
    n = len(hashes)
    if n < width:
        empty = np.zeros(0, np.int64)
        return empty, empty.astype(_U), empty.astype(_U)
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    first = np.flatnonzero(text[: n - width + 1] == text[width - 1 :])
    out = []
    for k, powers in enumerate(_IN_WINDOW):
        up, down = powers.to(n + 1)
        sums = np.zeros(n + 1, _U)
        np.cumsum((hashes if k == 0 else mix(hashes, 3)) * up[:n], out=sums[1:])
        out.append(mix((sums[first + width] - sums[first]) * down[first], k))
    return first, out[0], out[1]
