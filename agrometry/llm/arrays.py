"""Texts of an Arrow batch as byte arrays: words, their places and their 64-bit fingerprints.

Everything works on UTF-8 bytes.  The word rules used here only tell ASCII characters apart and count every byte of a
longer character as part of a word, so bytes and characters give the same words.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 500_000
KEPT_POWERS = SLICE_BYTES + 2
_ODD = 0x9E3779B97F4A7C15
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_STEP = np.uint64(0xD6E8FEB86659FD93)

#: Words are what lies between white space: 0x20 and 0x09 to 0x0D.
BLANK_WORDS = np.ones(256, bool)
BLANK_WORDS[[0x20, *range(0x09, 0x0E)]] = False
#: Words are digits, a to z and everything beyond ASCII.
PLAIN_WORDS = np.zeros(256, bool)
PLAIN_WORDS[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

SAME = np.arange(256, dtype=np.uint8)
LOWER = SAME.copy()
LOWER[0x41:0x5B] += 0x20


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * _MIX[0]
    x = x ^ (x >> np.uint64(27))
    x = x * _MIX[1]
    return x ^ (x >> np.uint64(31))


_tables: dict[str, np.ndarray] = {}


def _powers(odd: int, n: int) -> np.ndarray:
    found = np.full(n, odd, np.uint64)
    found[0] = 1
    return np.cumprod(found, out=found)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2**64, and of its inverse; those of a usual slice are kept."""
    back = pow(_ODD, -1, 1 << 64)
    if n > KEPT_POWERS:
        return _powers(_ODD, n), _powers(back, n)
    if not _tables:
        _tables.update(up=_powers(_ODD, KEPT_POWERS), down=_powers(back, KEPT_POWERS))
    return _tables["up"], _tables["down"]


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Fingerprint of values[start:end] for each pair: equal spans get equal fingerprints wherever they stand."""
    n = len(values)
    up, down = powers(max(n + 1, 1))
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(values * up[:n], out=total[1:])
    length = (ends - starts).astype(np.uint64)
    return mixed((total[ends] - total[starts]) * down[starts] + length * _STEP)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in a row and where each begins (one more entry for the end); null texts are empty."""
    column = column.fill_null("").cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if len(column) == 0 or column.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


_trim = getattr(ctypes.CDLL(None), "malloc_trim", lambda keep: 0)


def release() -> None:
    """Give memory that is no longer used back to the system, as a worker stays alive with what it holds."""
    pa.default_memory_pool().release_unused()
    _trim(0)


#: What an operator's worker keeps from one task to the next, and how it is dropped.
caches: dict[str, Callable[[], None]] = {}


def slices(batch: pa.RecordBatch, text: str, limit: int = SLICE_BYTES, owner: str | None = None) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with at most ``limit`` bytes of text each, or one row; memory is released after the last.

    Workers are shared by all operators of a session, so caches of another one than ``owner`` are dropped first.
    """
    for name in [name for name in caches if name != owner]:
        caches.pop(name)()
    column = batch.column(batch.schema.get_field_index(text))
    _, offsets = text_bytes(column)
    at = 0
    while at < len(column):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        yield batch.slice(at, end - at)
        at = end
    release()


@dataclass
class Words:
    """Words of several texts: byte places, fingerprints, and the first word of each text (one more for the end)."""

    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        """The text's number of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts())


def places(data: np.ndarray, offsets: np.ndarray, in_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of every run of word bytes; runs end where texts do."""
    inside = in_word[data]
    before = np.zeros(len(data) + 1, bool)
    before[1:] = inside
    after = before[1:].copy()
    begin = ~before[:-1]
    begin[offsets[:-1][offsets[:-1] < len(data)]] = True
    after[:-1] = ~inside[1:]
    after[-1:] = True
    after[offsets[1:][offsets[1:] > 0] - 1] = True
    return np.flatnonzero(inside & begin), np.flatnonzero(inside & after) + 1


def words(data: np.ndarray, offsets: np.ndarray, in_word: np.ndarray = BLANK_WORDS, case: np.ndarray = SAME) -> Words:
    """All words, with the case table applied before words are told apart and fingerprinted."""
    data = case[data]
    starts, ends = places(data, offsets, in_word)
    hashes = span_hashes(data.astype(np.uint64) + np.uint64(1), starts, ends)
    return Words(starts, ends, hashes, np.searchsorted(starts, offsets))


def shingles(found: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of all runs of ``size`` words and their texts' numbers; a text of fewer words, but not none, is one run."""
    n = len(found.hashes)
    counts = found.counts()
    last = np.repeat(found.first[1:], counts)
    at = np.arange(n)
    whole = at + size <= last
    short = found.first[:-1][(counts > 0) & (counts < size)]
    whole[short] = True
    starts = at[whole]
    ends = np.minimum(starts + size, last[whole])
    return span_hashes(found.hashes, starts, ends), found.text_of()[whole]


def character_places(data: np.ndarray, byte_places: np.ndarray, offsets: np.ndarray, text_of: np.ndarray) -> np.ndarray:
    """Byte places as numbers of characters since the begin of their texts."""
    seen = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=seen[1:])
    return seen[byte_places] - seen[offsets[text_of]]


def strings(values: list[str]) -> pa.Array:
    return pa.array(values, pa.string())


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of every run of true values."""
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def sliding_any(marks: np.ndarray) -> np.ndarray:
    """Turn +1 at begins and -1 at ends into covered places."""
    return np.cumsum(marks)[:-1] > 0


def cumulative(flags: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total
