"""Fill-in-middle transformation over a Roaring-style set of character boundaries.

Texts are cut between characters but handled as UTF-8 bytes, so each text gets the set of byte offsets at which a
character begins, and its end. The set is kept in containers of 65,536 offsets, each in the smallest of three forms:
runs (all of an ASCII text is one), a sorted array, or a bitmap. Containers carry their cumulative cardinality: the
k-th boundary is found by searching these for the container, then selecting within it. Two such selects give the
offsets at which prefix and middle end; no text is decoded.

Where to cut, and which form a text takes, come from a hash of the doc_id alone, so any run gives the same result.

Null and empty texts: ``plain``, with an empty output. A null doc_id counts as empty text in the hash. Texts
that hold one of the marks stay plain, so that an output can always be taken apart. Repeated rows are answered each;
rows of one doc_id share the random numbers. A long text costs its length and an eighth of it at most for the set.
Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.llm import hashing
from roadpulse.llm.common import ship

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Of a hundred texts, so many stay plain; of a hundred others, so many begin with the suffix.
PLAIN_PERCENT, SPM_PERCENT = 10, 20
SEED = 1

#: Offsets of one container, and the most that an array is better for than a bitmap.
SPAN = 1 << 16
BITMAP_BYTES = SPAN // 8


class Runs:
    """Stretches of neighbouring offsets: their starts, and how many offsets come before each."""

    def __init__(self, start: np.ndarray, stop: np.ndarray):
        self.start = start.astype(np.uint16)
        self.before = np.concatenate([[0], np.cumsum(stop - start)[:-1]])

    def select(self, k: int) -> int:
        at = int(np.searchsorted(self.before, k, "right")) - 1
        return int(self.start[at]) + k - int(self.before[at])


class Sorted:
    """The offsets themselves."""

    def __init__(self, member: np.ndarray):
        self.offsets = np.flatnonzero(member).astype(np.uint16)

    def select(self, k: int) -> int:
        return int(self.offsets[k])


class Bitmap:
    """A bit for each offset, in words of 64 with the number of bits before each word."""

    def __init__(self, member: np.ndarray):
        bits = np.packbits(member, bitorder="little")
        self.words = np.concatenate([bits, np.zeros(-len(bits) % 8, np.uint8)]).view(np.uint64)
        many = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(many) - many

    def select(self, k: int) -> int:
        at = int(np.searchsorted(self.before, k, "right")) - 1
        word, skip = int(self.words[at]), k - int(self.before[at])
        for _ in range(skip):
            word &= word - 1  # the lowest bit goes
        return 64 * at + (word & -word).bit_length() - 1


def container(member: np.ndarray) -> Runs | Sorted | Bitmap:
    """The smallest form for the offsets marked in ``member``."""
    edge = np.flatnonzero(np.diff(member.view(np.int8), prepend=0, append=0))
    size = int(np.count_nonzero(member))
    if 4 * (len(edge) // 2) + 2 < min(2 * size, BITMAP_BYTES):
        return Runs(edge[::2], edge[1::2])
    return Sorted(member) if 2 * size <= BITMAP_BYTES else Bitmap(member)


class Boundaries:
    """Offsets at which a character of UTF-8 bytes begins, and where they end."""

    def __init__(self, data: np.ndarray):
        self.containers, sizes = [], []
        for base in range(0, len(data) + 1, SPAN):
            member = (data[base : base + SPAN] & 0xC0) != 0x80
            if len(member) < SPAN:
                member = np.append(member, True)
            self.containers.append(container(member))
            sizes.append(int(np.count_nonzero(member)))
        self.before = [0, *accumulate(sizes)]

    def __len__(self) -> int:
        return self.before[-1]

    def select(self, k: int) -> int:
        """The k-th boundary, from 0."""
        at = bisect_right(self.before, k) - 1
        return at * SPAN + self.containers[at].select(k - self.before[at])


def draws(doc_id: int | None, seed: int = SEED) -> tuple[int, int, int, int]:
    """Four numbers below 2**32 from the hash of seed and id."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[k : k + 4], "big") for k in (0, 4, 8, 12))


def transform(
    data: bytes, doc_id: int | None, seed: int = SEED, plain: int = PLAIN_PERCENT, spm: int = SPM_PERCENT
) -> tuple[int, str, int | None, int | None, bytes]:
    """(characters, form, characters of the prefix, of the middle, output) of one text."""
    found = Boundaries(np.frombuffer(data, np.uint8))
    n = len(found) - 1
    one, two, three, four = draws(doc_id, seed)
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
    if not n or three % 100 >= 100 - plain or any(m in data for m in marks):
        return n, "plain", None, None, data
    low, high = sorted((one % (n + 1), two % (n + 1)))
    a, b = found.select(low), found.select(high)
    head, middle, tail = data[:a], data[a:b], data[b:]
    p, s, m = marks
    if four % 100 < spm:
        return n, "spm", low, high - low, b"".join([s, tail, p, head, m, middle])
    return n, "psm", low, high - low, b"".join([p, head, s, tail, m, middle])


_SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def _transformed(seed: int, plain: int, spm: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in hashing.pieces(batch):
                texts = hashing.as_texts(piece.column("text"))
                ids = piece.column("doc_id").to_pylist()
                ends = texts.offsets.tolist()
                rows = [
                    (doc, *transform(texts.data[a:b].tobytes(), doc, seed, plain, spm))
                    for doc, a, b in zip(ids, ends[:-1], ends[1:], strict=True)
                ]
                doc, n, form, prefix, middle, output = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(doc, pa.int64()),
                        pa.array(n, pa.int64()),
                        pa.array(form, pa.string()),
                        pa.array(prefix, pa.int64()),
                        pa.array(middle, pa.int64()),
                        pa.array(output, pa.binary()).cast(pa.string()),
                    ],
                    names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
                )

    return run


def fill_in_middle(
    documents: DataFrame, seed: int = SEED, plain: int = PLAIN_PERCENT, spm: int = SPM_PERCENT
) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) per row."""
    ship(documents.sparkSession)
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(_transformed(seed, plain, spm), _SCHEMA)


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made from."""
    # Three parts: a text that is not plain holds no mark, and none can arise where a part meets a mark.
    part = F.split(F.substr(output, F.lit(len(PREFIX) + 1)), "|".join((PREFIX, SUFFIX, MIDDLE)), -1)
    return (
        F.when(form == "psm", F.concat(part[0], part[2], part[1]))
        .when(form == "spm", F.concat(part[1], part[2], part[0]))
        .otherwise(output)
    )


def fim_digests(documents: DataFrame) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256) per row."""
    made = fill_in_middle(documents)
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )
