"""Best-fit decreasing packing into windows, with a segment tree over the room that is left.

1. Documents are tokenised once, long ones in parts that end before white space. An overlong document is first
   cut into full windows from its begin; each is a sequence of its own and goes nowhere. What is left of it, like
   any shorter document, is one piece.
2. Pieces are dealt by hash into shards of about SHARD_TOKENS tokens, whatever their length or document. A shard is
   packed in one task: from the longest piece down, each goes to the open window with the least room that
   holds it. A segment tree over rooms, counting the open windows below each node, finds it in log steps.
3. A sequence is padded to a full window unless its length is a power of two. Windows that would be padded give
   way: the emptiest are taken apart, and their pieces, cut where need be, fill the others. The one that remains in
   a shard is cut into sequences of powers of two, so no token is padding.

Null and empty texts: one piece, the end id alone. A null doc_id stays null; repeated rows are packed each, also
under one doc_id. Extra columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm import packing
from roadpulse.llm.common import ship
from roadpulse.session import materialize

LIMIT = 2048
END_ID = 1
#: Tokens of a shard, about. Ids of the vocabulary fit two bytes.
SHARD_TOKENS = 4_000_000
ID = "<u2"
#: Long texts are tokenised in parts of about so many characters.
PART = 1_000_000

#: White space after something else: no word of the tokenizer's pattern goes on across its begin.
_BREAK = re.compile(rf"(?<!{packing._SPACE}){packing._SPACE}")

Part = tuple[int, int, int]  # piece, its first token, how many


class RoomTree:
    """Open windows by the room left in each: a segment tree that counts them, leaf by leaf of room."""

    def __init__(self, limit: int):
        self.leaves = 1 << limit.bit_length()
        self.many = [0] * (2 * self.leaves)
        self.windows: dict[int, list[int]] = {}

    def _add(self, room: int, change: int) -> None:
        node = self.leaves + room
        while node:
            self.many[node] += change
            node >>= 1

    def put(self, room: int, window: int) -> None:
        self.windows.setdefault(room, []).append(window)
        self._add(room, 1)

    def tightest(self, least: int) -> int | None:
        """The smallest room of at least ``least`` that an open window has."""
        node, many = self.leaves + least, self.many
        while not many[node]:
            # Up until there is a subtree to the right with windows in it, then down its left side.
            while node & 1 or not many[node + 1]:
                node >>= 1
                if node <= 1:
                    return None
            node += 1
            while node < self.leaves:
                node *= 2
                if not many[node]:
                    node += 1
        return node - self.leaves

    def take(self, room: int) -> int:
        self._add(room, -1)
        return self.windows[room].pop()


def best_fit(lengths: list[int], limit: int = LIMIT) -> list[list[int]]:
    """Windows as lists of pieces, which come in the order given and are at most ``limit`` long."""
    tree, windows = RoomTree(limit), []
    for piece, length in enumerate(lengths):
        room = tree.tightest(length)
        if room is None:
            window, room = len(windows), limit
            windows.append([])
        else:
            window = tree.take(room)
        windows[window].append(piece)
        if room > length:
            tree.put(room - length, window)
    return windows


def _fixed(size: int, limit: int) -> bool:
    """Whether a sequence of that size is not padded."""
    return size == limit or size & (size - 1) == 0


def settle(windows: list[list[int]], lengths: list[int], limit: int = LIMIT) -> list[list[Part]]:
    """Sequences without padding: windows that would have some are filled from the emptiest of them."""
    whole = [[(p, 0, lengths[p]) for p in w] for w in windows]
    size = [sum(lengths[p] for p in w) for w in windows]
    out = [w for w, n in zip(whole, size, strict=True) if _fixed(n, limit)]
    ragged = sorted((k for k, n in enumerate(size) if not _fixed(n, limit)), key=lambda k: (-size[k], k))
    first, last = 0, len(ragged) - 1
    while first < last:
        to, source = whole[ragged[first]], whole[ragged[last]]
        room = limit - size[ragged[first]]
        piece, start, many = source.pop()  # the shortest
        moved = min(many, room)
        to.append((piece, start, moved))
        if moved < many:
            source.append((piece, start + moved, many - moved))
        size[ragged[first]] += moved
        size[ragged[last]] -= moved
        if moved == room:
            out.append(to)
            first += 1
        if not source:
            last -= 1
    if first == last:
        out += _powers(whole[ragged[first]], size[ragged[first]])
    return out


def _powers(parts: list[Part], size: int) -> list[list[Part]]:
    """Parts cut into sequences whose lengths are the powers of two that make up their size."""
    out, left = [], list(reversed(parts))
    for power in (1 << k for k in reversed(range(size.bit_length())) if size >> k & 1):
        sequence = []
        while power:
            piece, start, many = left.pop()
            taken = min(many, power)
            sequence.append((piece, start, taken))
            if taken < many:
                left.append((piece, start + taken, many - taken))
            power -= taken
        out.append(sequence)
    return out


def token_ids(text: str | None, path: str | None = None, part: int = PART) -> np.ndarray:
    """Ids of a whole text, then the end id. A long text goes through the tokenizer in parts."""
    text = text or ""
    out, start = [], 0
    while start < len(text):
        stop = len(text)
        if stop - start > part:
            found = _BREAK.search(text, start + part)
            stop = found.start() if found else stop
        out.append(packing.token_ids(text[start:stop], path)[:-1].astype(ID))
        start = stop
    return np.concatenate([*out, np.array([END_ID], ID)])


def checksum(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


_PIECES = "doc_id long, start long, length long, doc_tokens long, ids_crc32 long, ids binary"
_PLACED = f"{_PIECES}, sequence_id long, offset long"


def _rows(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    kind = {"ids": pa.binary()}
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kind.get(n, pa.int64())) for n, c in zip(names, columns, strict=True)], names=names
    )


def _names(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(", ")]


def _tokenise(limit: int, path: str | None, keep_ids: bool):
    """Full windows of overlong documents with their checksum, and pieces with their ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, held = [], 0
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                ids = token_ids(text.as_py(), path)
                full = (len(ids) - 1) // limit * limit
                for start in range(0, full, limit):
                    part = ids[start : start + limit]
                    rows.append((doc, start, limit, len(ids), checksum(part), part.tobytes() if keep_ids else None))
                rows.append((doc, full, len(ids) - full, len(ids), None, ids[full:].tobytes()))
                held += len(ids)
                if held > SHARD_TOKENS:
                    yield _rows(rows, _names(_PIECES))
                    rows, held = [], 0
            yield _rows(rows, _names(_PIECES))

    return run


def _pack_shard(limit: int, keep_ids: bool):
    def run(group: pa.Table) -> pa.Table:
        shard = group.column("shard")[0].as_py()
        columns = [group.column(c).to_pylist() for c in ("length", "doc_id", "start", "doc_tokens", "ids")]
        # Longest first; a fixed order among equals, so that a task run again gives the same.
        pieces = sorted(
            zip(*columns, strict=True), key=lambda p: (-p[0], p[1] is None, p[1] or 0, p[2], p[3], p[4])
        )
        lengths = [p[0] for p in pieces]
        rows = []
        for number, sequence in enumerate(settle(best_fit(lengths, limit), lengths, limit)):
            offset = 0
            for piece, first, many in sequence:
                _, doc, start, doc_tokens, data = pieces[piece]
                ids = np.frombuffer(data, ID)[first : first + many]
                kept = ids.tobytes() if keep_ids else None
                rows.append((doc, start + first, many, doc_tokens, checksum(ids), kept, (shard << 31) + number, offset))
                offset += many
        return pa.Table.from_batches([_rows(rows, _names(_PLACED))])

    return run


def pack_windows(
    documents: DataFrame, limit: int = LIMIT, path: str | None = None, keep_ids: bool = True
) -> DataFrame:
    """(doc_id, start, length, doc_tokens, ids_crc32, ids, sequence_id, offset) per piece; ``ids`` are
    little-endian numbers of two bytes, null without ``keep_ids``."""
    ship(documents.sparkSession)
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    pieces = materialize(texts.mapInArrow(_tokenise(limit, path, keep_ids), _PIECES), "window-pieces")
    loose = pieces.filter("ids_crc32 is null")
    shards = int((loose.agg(F.sum("length")).first()[0] or 0) // SHARD_TOKENS) + 1
    packed = (
        loose.withColumn("shard", F.pmod(F.xxhash64("doc_id", "start", "ids"), F.lit(shards)))
        .groupBy("shard")
        .applyInArrow(_pack_shard(limit, keep_ids), _PLACED)
    )
    full = pieces.filter("ids_crc32 is not null").select(
        "*", (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    return packed.unionByName(full)


def window_digests(documents: DataFrame, limit: int = LIMIT) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) per piece."""
    return pack_windows(documents, limit, keep_ids=False).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )
