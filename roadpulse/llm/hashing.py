"""Words and shingles of a batch of texts as arrays of 64-bit hashes, without a loop over words."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import wraps

import numpy as np
import pyarrow as pa

#: Odd, so that it has an inverse among the 64-bit numbers: hashes of words can be read off one running sum.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 2**64)

#: Text is worked on in pieces of about so many bytes, whatever the size of a batch.
PIECE_BYTES = 1_000_000

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of the 64-bit numbers that spreads each bit over all."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))


def powers(of: int, n: int) -> np.ndarray:
    """of ** 0 ... of ** (n - 1), kept for the next call."""
    have = _powers.get(of)
    if have is None or len(have) < n:
        size = 1 << max(n - 1, 1).bit_length()
        steps = np.full(size, of, np.uint64)
        steps[0] = 1
        have = _powers[of] = np.cumprod(steps, dtype=np.uint64)
    return have[:n]


def running_hash(data: np.ndarray, values: np.ndarray = _BYTE_VALUES) -> np.ndarray:
    """Sums over data[:i] of the letter's value times BASE ** place, for i from 0 to len(data)."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(values[data] * powers(BASE, len(data)), out=out[1:])
    return out


def range_hash(running: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of data[start:end]; equal bytes give equal hashes wherever they stand."""
    back = powers(INVERSE, len(running))
    length = (end - start).astype(np.uint64)
    return mix((running[end] - running[start]) * back[start] + length * np.uint64(0xD6E8FEB86659FD93))


@dataclass
class Texts:
    """Bytes of several texts; text i is data[offsets[i]:offsets[i + 1]]."""

    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1


def as_texts(column: pa.Array) -> Texts:
    """A string column; nulls are empty."""
    column = column.fill_null("").cast(pa.large_string()) if column.null_count else column.cast(pa.large_string())
    _, ends, values = column.buffers()
    offsets = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)
    return Texts(data[offsets[0] : offsets[-1]], offsets - offsets[0])


def pieces(batch: pa.RecordBatch, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about PIECE_BYTES of text; a longer text makes a slice of its own."""
    if not batch.num_rows:
        return
    ends = as_texts(batch.column(column)).offsets
    start = 0
    while start < batch.num_rows:
        stop = int(np.searchsorted(ends, ends[start] + PIECE_BYTES, "right")) - 1
        stop = min(max(stop, start + 1), batch.num_rows)
        yield batch.slice(start, stop - start)
        start = stop


def give_back() -> None:
    """Return free memory to the system: a worker waits for its next task with all it has ever held."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library only
    if trim is not None:
        trim(0)


def giving_back(run: Callable) -> Callable:
    """A function over batches that gives memory back when its task ends."""

    @wraps(run)
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped


def without_marks(data: np.ndarray) -> np.ndarray:
    """With spaces for the marks and signs that stand next to letters: quotes, dashes and the like
    (U+0080 to U+00BF, U+2000 to U+207F)."""
    out = data
    low = np.flatnonzero(data[:-1] == 0xC2) if len(data) else np.zeros(0, np.int64)
    high = np.flatnonzero((data[:-2] == 0xE2) & (data[1:-1] <= 0x81)) if len(data) > 2 else low[:0]
    if len(low) or len(high):
        out = data.copy()
        for k in range(2):
            out[low + k] = 0x20
        for k in range(3):
            out[high + k] = 0x20
    return out


@dataclass
class Words:
    """Runs of bytes other than ASCII white space, in order."""

    text: np.ndarray  # number of the text that holds the word
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    running: np.ndarray  # see running_hash

    def counts(self, texts: int) -> np.ndarray:
        return np.bincount(self.text, minlength=texts)


def words(texts: Texts, lower: bool = True, inside: np.ndarray | None = None) -> Words:
    """``inside`` tells by byte value what belongs to a word; without it, all but white space."""
    data = LOWER[texts.data] if lower else texts.data
    within = ~_IS_SPACE[data] if inside is None else inside[data]
    n = len(data)
    edge = np.zeros(n + 1, bool)
    edge[texts.offsets] = True
    before = np.zeros(n, bool)
    before[1:] = within[:-1]
    after = np.zeros(n, bool)
    after[:-1] = within[1:]
    start = np.flatnonzero(within & (~before | edge[:-1]))
    end = np.flatnonzero(within & (~after | edge[1:])) + 1
    text = np.searchsorted(texts.offsets, start, "right") - 1
    running = running_hash(data)
    return Words(text, start, end, range_hash(running, start, end), running)


def shingles(found: Words, n_texts: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of each run of ``size`` words; a text of fewer words, but some, is one run."""
    text, h = found.text, found.hash
    counts = found.counts(n_texts)
    if len(h) >= size:
        whole = np.flatnonzero(text[size - 1 :] == text[: len(text) - size + 1])
        value = np.zeros(len(whole), np.uint64)
        for k in range(size):
            value = mix(value * np.uint64(BASE) + h[whole + k])
        owner = text[whole]
    else:
        owner, value = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    few = np.flatnonzero((counts > 0) & (counts < size))
    if len(few):
        first = np.concatenate([[0], np.cumsum(counts)])[few]
        short = counts[few].astype(np.uint64)
        for k in range(size - 1):
            more = counts[few] > k
            at = np.minimum(first + k, len(h) - 1)
            short = np.where(more, mix(short * np.uint64(BASE) + h[at]), short)
        owner, value = np.concatenate([owner, few]), np.concatenate([value, short])
    return owner, value


def distinct(owner: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each (owner, value) once, ordered by both."""
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    keep = np.ones(len(owner), bool)
    keep[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
    return owner[keep], value[keep]


def lists(owner: np.ndarray, value: pa.Array, n: int) -> pa.ListArray:
    """Values ordered by owner as one list for each of n owners."""
    ends = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), value)
