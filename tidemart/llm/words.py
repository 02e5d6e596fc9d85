"""Words and word shingles of Arrow text columns, as numpy arrays over the UTF-8 bytes.

A word is a run of bytes other than space and tab to carriage return. No byte of a multi-byte
character is one of those, so cutting bytes and cutting characters give the same words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SEPARATORS = b" \t\n\x0b\x0c\r"
BLOCK_BYTES = 1 << 21

_IS_WORD = np.ones(256, bool)
_IS_WORD[list(SEPARATORS)] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

_ODD = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_blocks(
    column: pa.Array, limit: int = BLOCK_BYTES
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of rows of about ``limit`` bytes: first row, the bytes, and the rows' offsets in them.

    A null is an empty text. A longer text makes a block of its own.
    """
    column = column.cast(pa.large_binary()).fill_null(b"")
    if not len(column):
        return
    _, places, values = column.buffers()
    offsets = np.frombuffer(places, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), len(column))
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


# Plain words are runs of a-z, 0-9 and bytes of other scripts, A-Z lower-cased; all else is blank.
_PLAIN = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def plain_words(text: bytes, limit: int = BLOCK_BYTES) -> Iterator[list[bytes]]:
    """The plain words of a UTF-8 text in order, in lists of about ``limit`` bytes of text each."""
    if len(text) <= limit:
        yield text.translate(_PLAIN).split()
        return
    first = 0
    while first < len(text):
        block = text[first : first + limit].translate(_PLAIN)
        first += limit
        # The word at the end may go on, and a word longer than the limit takes its blocks together.
        while first < len(text) and block[-1] != 32:
            more = text[first : first + 4096].translate(_PLAIN)
            cut = more.find(b" ") + 1 or len(more)
            block += more[:cut]
            first += cut
        yield block.split()


class Words:
    """Where the words of a block of texts start and end, and how many each text has."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        inside = _IS_WORD[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        before = np.empty(len(data), bool)
        if len(data):
            before[0] = False
            before[1:] = inside[:-1]
        self.starts = np.flatnonzero(inside & (~before | edge[:-1]))
        after = np.empty(len(data), bool)
        if len(data):
            after[-1] = False
            after[:-1] = inside[1:]
        self.ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
        self.data, self.inside = data, inside
        # Of text i the words bounds[i] to bounds[i + 1].
        self.bounds = np.searchsorted(self.starts, offsets)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash per word."""
        lengths = self.ends - self.starts
        if not len(lengths):
            return np.zeros(0, np.uint64)
        letters = self.data[self.inside].astype(np.uint64) + np.uint64(1)
        begin = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        powers = np.cumprod(np.full(int(lengths.max()), _ODD, np.uint64))
        letters *= powers[np.arange(len(letters)) - np.repeat(begin, lengths)]
        return mixed(np.add.reduceat(letters, begin) + lengths.astype(np.uint64))


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` words; runs that cross into the next text are the caller's."""
    if len(hashes) < size:
        return np.zeros(0, np.uint64)
    n = len(hashes) - size + 1
    out = hashes[:n].copy()
    for j in range(1, size):
        out = mixed(out * _ODD + hashes[j : j + n])
    return out


def shingle_sets(column: pa.Array, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """Row and sorted distinct shingle hashes of every text, A-Z lower-cased.

    A text with fewer words than ``size`` has its whole word sequence as the one shingle, a text
    without words or a null none.
    """
    for first, data, offsets in text_blocks(column):
        words = Words(lower_ascii(data), offsets)
        hashes = words.hashes()
        runs = windows(hashes, size)
        bounds = words.bounds.tolist()
        for row in range(len(bounds) - 1):
            low, high = bounds[row], bounds[row + 1]
            if high - low >= size:
                yield first + row, np.unique(runs[low : high - size + 1])
            elif high > low:
                yield first + row, windows(hashes[low:high], high - low)
            else:
                yield first + row, np.zeros(0, np.uint64)
