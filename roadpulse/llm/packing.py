"""Best-fit packing by a plan over the length histogram.

Documents are tokenised once; what is kept of a piece is its length and a checksum. Only the histogram
of lengths (at most LIMIT bins) comes to the driver. There, best fit decreasing runs over counts:
sequences with the same room left are one class, and a step places as many pieces of one length as
the class has sequences. The plan is a table of ranges: pieces of a length with ranks from a to b take
the sequences from s on, at one offset. Pieces then get their rank within their length and join the plan.

Null and empty texts: one piece, the end id alone. A null doc_id stays null; repeated rows are packed each,
also under one doc_id. A long text is cut into pieces, the first of them the shorter one. Extra columns are
ignored. An empty table gives no rows.
"""

from __future__ import annotations

import base64
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.llm.common import ship
from roadpulse.session import materialize

LIMIT = 2048
END_ID = 0
#: Ranks are numbered in groups of about so many pieces, so that a frequent length is no single group.
RANK_GROUP = 50_000

#: The tokenizer, and its vocabulary as ranks: faster, with the same ids for texts without the added token
#: and without a run of white space so long that matching the pattern gives up (700,000 characters pass).
TOKENIZER, VOCABULARY = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"
ADDED, ADDED_ID = "<|endoftext|>", 50256
LONG_SPACE = 100_000

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


@lru_cache(maxsize=2)
def _encoding(path: str):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


@lru_cache(maxsize=1)
def _tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(TOKENIZER))


#: White space as the pattern has it.
_SPACE = r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


@lru_cache(maxsize=2)
def _long_spaces(least: int) -> re.Pattern:
    """Long runs of white space but for the last before other text, which goes with what follows: to the
    pattern, each is one word."""
    return re.compile(rf"(?<!{_SPACE}){_SPACE}{{{least},}}(?:(?={_SPACE})|\Z)")


def token_ids(text: str | None, path: str | None = None) -> np.ndarray:
    """Ids of a whole text, then the end id."""
    ranks = _encoding(path or public_tokenizers.path(VOCABULARY))
    ids: list[int] = []
    for n, part in enumerate((text or "").split(ADDED)):
        if n:
            ids.append(ADDED_ID)
        done = 0
        for run in _long_spaces(LONG_SPACE).finditer(part) if len(part) > LONG_SPACE else ():
            ids += ranks.encode_ordinary(part[done : run.start()])
            ids += _tokenizer().encode(run.group(), add_special_tokens=False).ids
            done = run.end()
        ids += ranks.encode_ordinary(part[done:])
    return np.array([*ids, END_ID], "<u4")


def cut(n: int, limit: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of n ids; only the first may be shorter than the limit."""
    first = n % limit or limit
    starts = [0, *range(first, n, limit)]
    return [(s, min(e, n) - s) for s, e in zip(starts, [*starts[1:], n], strict=True)]


def _tokenise(limit: int, path: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                ids = token_ids(text.as_py(), path)
                for k, (start, length) in enumerate(cut(len(ids), limit)):
                    rows.append((doc_id, k, start, length, zlib.crc32(ids[start : start + length].tobytes())))
            doc, piece, start, length, crc = zip(*rows, strict=True) if rows else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(doc, pa.int64()),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(crc, pa.int64()),
                ],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return run


def plan(histogram: dict[int, int], limit: int = LIMIT) -> list[tuple[int, int, int, int, int]]:
    """Ranges (length, first rank, last rank + 1, first sequence, offset), by best fit decreasing."""
    ranges: list[tuple[int, int, int, int, int]] = []
    rooms: list[int] = []  # ascending
    open_at: dict[int, list[tuple[int, int]]] = {}  # by room: runs (first sequence, how many)
    sequences = 0

    def leave(room: int, first: int, many: int) -> None:
        if room not in open_at:
            insort(rooms, room)
            open_at[room] = []
        open_at[room].append((first, many))

    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                many = -(-left // (limit // length))
                leave(limit, sequences, many)
                sequences += many
                continue
            room = rooms[at]
            first, many = open_at[room].pop()
            if not open_at[room]:
                del open_at[room]
                rooms.pop(at)
            if many > left:
                leave(room, first + left, many - left)
                many = left
            ranges.append((length, rank, rank + many, first, limit - room))
            if room > length:
                leave(room - length, first, many)
            rank, left = rank + many, left - many
    return ranges


def pack(documents: DataFrame, limit: int = LIMIT, path: str | None = None) -> DataFrame:
    spark = documents.sparkSession
    ship(spark)
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    pieces = materialize(texts.mapInArrow(_tokenise(limit, path), _PIECES), "pieces")
    groups = max(1, pieces.count() // RANK_GROUP)
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(groups)))
    sizes = materialize(salted.groupBy("length", "salt").count(), "piece-sizes")
    histogram = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    slots = spark.createDataFrame(
        plan(histogram, limit), "length long, low long, high long, first long, offset long"
    )
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("length", "salt", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    order = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (
        salted.withColumn("rank", F.row_number().over(order) - 1)
        .join(bases, ["length", "salt"])
        .withColumn("rank", F.col("rank") + F.col("base"))
    )
    placed = ranked.join(F.broadcast(slots), "length").filter("rank >= low and rank < high")
    return placed.select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.col("first") + F.col("rank") - F.col("low")).alias("sequence_id"),
        "offset",
    )
