"""Suffix-array deduplication: bytes covered by long strings that also start elsewhere.

A string of ``size`` bytes at any place is a window. Each window has an anchor, the GRAM bytes in it of smallest
hash, the first of equals; so equal windows have equal anchors at equal distances. Windows of a text
that share one anchor make a segment.

1. Segments are found in one pass over the texts. Those whose anchor occurs once in the corpus repeat nothing. Where a
   text repeats a few bytes over and over, each turn is a segment; equal neighbours are one row with their number.
2. Equal segments are counted before anything else moves (hot copies meet as one class): all their windows repeat.
3. An anchor with different segments is contested: segments may agree in some windows. One segment of each class
   goes, with its text, to a shard by anchor. BLOCK neighbouring windows have most of their bytes in common, the
   core; only blocks of equal core can agree. A core becomes a mark and DIGITS letters, what stands left and right
   of it stays. These strings are sorted by external induced sorting (``suffixes``): a window repeats
   where the common prefix with a neighbour covers its left bytes, its core and its right bytes.
4. An anchor with over CROWD classes would make a shard too large. Its blocks are counted instead, and, where blocks of
   equal core differ, their windows; that needs no group, and the result is the same.

Null and empty texts, and texts shorter than ``size``: nothing removed. A null doc_id is answered like any other.
Repeated rows repeat each other, also under one doc_id. Long texts are worked on in parts of PART
bytes. Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from roadpulse.llm import hashing
from roadpulse.llm.common import ship
from roadpulse.llm.suffixes import repeated
from roadpulse.session import materialize, materialized_for

#: op7's length, by its contract.
SIZE = 400
#: The operators' own: passages of over 50 words are to be found, and 51 words of four letters with the spaces between
#: them have 254 bytes.
PASSAGE = 250
GRAM = 64
#: Windows of a long text are found in parts of so many bytes.
PART = hashing.PIECE_BYTES
CROWD = 1_000
#: Segments of a shard, about; with those of one anchor on top, at most CROWD segments more.
SHARD_BYTES = 1_000_000
BLOCK = 8
DIGITS = 4
MARK = 257

#: Stands for a null id; a text's key is its id and a hash of the text.
_NO_ID = -(2**63)


def _least_in(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` neighbours: prefix minima of blocks meet suffix minima of the block before."""
    n = len(values)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    rows = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def segments(texts: hashing.Texts, size: int = SIZE, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(text, first window, windows, distance of the anchor, its hash, content hash) of every segment."""
    data, ends = texts.data, texts.offsets
    if len(data) < size:
        return tuple(np.zeros(0, np.int64) for _ in range(4)) + tuple(np.zeros(0, np.uint64) for _ in range(2))
    running = hashing.running_hash(data)
    back = hashing.powers(hashing.INVERSE, len(data))
    grams = (running[gram:] - running[:-gram]) * back[: len(data) - gram + 1]
    order = (grams ^ (grams >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    # Hash above, place below: the least is the smallest hash at its first place.
    order = (order >> np.uint64(32) << np.uint64(32)) | np.arange(len(order), dtype=np.uint64)
    anchor = (_least_in(order, size - gram + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    window = np.arange(len(anchor))
    text = np.repeat(np.arange(len(texts)), np.diff(ends))[: len(anchor)]
    inside = window + size <= ends[text + 1]
    new = np.ones(len(anchor), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | ~inside[:-1]
    first = np.flatnonzero(new & inside)
    if not len(first):
        return segments(hashing.Texts(data[:0], ends[:1]), size, gram)
    # A segment ends where the next begins or the text's windows do.
    last = np.maximum(ends[text[first] + 1] - size + 1, first + 1)
    end = np.minimum(np.append(first[1:], len(anchor)), last)
    at = anchor[first]
    content = hashing.range_hash(running, first, end + size - 1)
    content = hashing.mix(content + (at - first).astype(np.uint64) * np.uint64(hashing.BASE))
    owner = text[first]
    return owner, first - ends[owner], end - first, at - first, hashing.range_hash(running, at, at + gram), content


def in_runs(found: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
    """What ``segments`` gives, with equal segments that follow one another in a text as the first of them, and how
    many they are."""
    text, low, many, _, gram, content = found
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (low[1:] != low[:-1] + many[:-1]) | (many[1:] != many[:-1])
    new[1:] |= (gram[1:] != gram[:-1]) | (content[1:] != content[:-1])
    first = np.flatnonzero(new)
    return *(c[first] for c in found), np.diff(np.append(first, len(text)))


_SEGMENTS = "doc long, key long, low long, many int, ahead int, gram long, content long, times int"


def _segments(size: int):
    @hashing.giving_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in hashing.pieces(batch):
                texts = hashing.as_texts(piece.column("text"))
                doc, key = (piece.column(c).to_numpy(zero_copy_only=False) for c in ("doc", "key"))
                for part, base in _parts(texts, size):
                    text, low, many, ahead, gram, content, times = in_runs(segments(part, size))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(doc[text]),
                            pa.array(key[text]),
                            pa.array(low + base),
                            pa.array(many.astype(np.int32)),
                            pa.array(ahead.astype(np.int32)),
                            pa.array(gram.view(np.int64)),
                            pa.array(content.view(np.int64)),
                            pa.array(times.astype(np.int32)),
                        ],
                        names=["doc", "key", "low", "many", "ahead", "gram", "content", "times"],
                    )

    return run


def _parts(texts: hashing.Texts, size: int) -> Iterator[tuple[hashing.Texts, int]]:
    """The texts as they are, or one long text in parts that overlap, so that each window is in one part."""
    if len(texts) > 1 or len(texts.data) <= PART:
        yield texts, 0
        return
    for base in range(0, len(texts.data) - size + 1, PART):
        part = texts.data[base : base + PART + size - 1]
        yield hashing.Texts(part, np.array([0, len(part)])), base


def _keyed(documents: DataFrame) -> DataFrame:
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID))
    text = F.coalesce("text", F.lit(""))
    return documents.select(doc.alias("doc"), F.xxhash64("text").alias("key"), text.alias("text"))


def _part_bytes(batch: pa.RecordBatch, size: int) -> Iterator[tuple[list[bytes], dict[str, np.ndarray]]]:
    """Bytes of the contested segments of a batch of texts with the columns that belong to them; about
    PIECE_BYTES of text, and of segments, at a time."""
    for piece in hashing.pieces(batch):
        texts, parts = hashing.as_texts(piece.column("text")), piece.column("parts")
        flat = parts.flatten()
        columns = {n: flat.field(n).to_numpy(zero_copy_only=False) for n in ("low", "many", "ahead", "gram", "lone")}
        owner = np.repeat(np.arange(piece.num_rows), parts.value_lengths().to_numpy())
        for name in ("doc", "key"):
            columns[name] = piece.column(name).to_numpy()[owner]
        begin = texts.offsets[owner] + columns["low"]
        end = begin + columns["many"] + size - 1
        group = np.cumsum(end - begin) // hashing.PIECE_BYTES
        data = memoryview(texts.data)
        for rows in np.split(np.arange(len(owner)), np.flatnonzero(np.diff(group)) + 1):
            if len(rows):
                cut = [bytes(data[x:y]) for x, y in zip(begin[rows].tolist(), end[rows].tolist(), strict=True)]
                yield cut, {n: c[rows] for n, c in columns.items()}


def _texts_of(size: int):
    """The text of every contested segment."""

    @hashing.giving_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cut, columns in _part_bytes(batch, size):
                names = ("gram", "lone", "ahead", "doc", "key", "low")
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(columns[n]) for n in names), pa.array(cut, pa.binary())], names=[*names, "part"]
                )

    return run


@dataclass
class Blocks:
    """BLOCK neighbouring windows each, or what a segment has of them; windows count from the segment's begin.

    A block's windows have their anchor at ``number * block`` to ``number * block + block - 1`` bytes. Blocks of one
    ``kind`` have equal cores at equal distances; of one ``whole``, all bytes.
    """

    of: np.ndarray  # the segment
    number: np.ndarray
    first: np.ndarray
    last: np.ndarray
    core: np.ndarray  # place of the core in the data
    kind: np.ndarray
    whole: np.ndarray


def blocks_of(data: np.ndarray, base: np.ndarray, many: np.ndarray, ahead: np.ndarray, size: int, block: int) -> Blocks:
    """Blocks of segments that begin at ``base`` in the data; from the last windows' to the first ones'."""
    running = hashing.running_hash(data)
    low, high = (ahead - many + 1) // block, ahead // block
    of = np.repeat(np.arange(len(base)), high - low + 1)
    number = np.arange(len(of)) - np.repeat(np.cumsum(high - low + 1) - (high - low + 1), high - low + 1) + low[of]
    first = np.maximum(ahead[of] - block * number - block + 1, 0)
    last = np.minimum(ahead[of] - block * number, many[of] - 1)
    core = base[of] + ahead[of] - block * number
    kind = hashing.mix(hashing.range_hash(running, core, core + size - block + 1) + number.astype(np.uint64))
    whole = hashing.range_hash(running, base[of] + first, base[of] + last + size)
    return Blocks(of, number, first, last, core, kind, hashing.mix(kind + whole + (last - first).astype(np.uint64)))


def repeated_windows(
    parts: list[bytes], ahead: np.ndarray, size: int = SIZE, gram: int = GRAM, block: int = BLOCK
) -> tuple[np.ndarray, np.ndarray]:
    """(part, window) of all windows that occur twice in the parts, ordered; ``ahead`` is how far each part's
    anchor lies from its begin. Windows that are equal must have their anchors at the same distance."""
    data = np.frombuffer(b"".join(parts), np.uint8)
    sizes = np.array([len(p) for p in parts], np.int64)
    base, many = np.cumsum(sizes) - sizes, sizes - size + 1
    found = blocks_of(data, base, many, ahead, size, block)
    of, first, last, core, kind, whole = found.of, found.first, found.last, found.core, found.kind, found.whole
    width = size - block + 1
    _, same, copies = np.unique(whole, return_inverse=True, return_counts=True)
    agree = copies[same] > 1
    _, at, group = np.unique(whole, return_index=True, return_inverse=True)
    kinds, kind_of = np.unique(kind[at], return_inverse=True)
    rivals = np.bincount(kind_of, minlength=len(kinds))[kind_of] > 1
    one, label = at[rivals], kind_of[rivals]
    # Letters of one row: left bytes, the mark, the core's digits, right bytes, the end.
    left, right = core[one] - base[of[one]] - first[one], base[of[one]] + last[one] + size - core[one] - width
    rows = np.zeros((len(one), 2 * block + DIGITS), np.int16)
    used = np.ones(rows.shape, bool)
    for k in range(block - 1):
        used[:, k], used[:, block + DIGITS + k] = k < left, k < right
        rows[:, k] = data[np.minimum(base[of[one]] + first[one] + k, len(data) - 1)] + np.int16(1)
        rows[:, block + DIGITS + k] = data[np.minimum(core[one] + width + k, len(data) - 1)] + np.int16(1)
    rows[:, block - 1] = MARK
    for k in range(DIGITS):
        rows[:, block + k] = (label >> (8 * k) & 255) + 1
    begin = np.concatenate([[0], np.cumsum(used.sum(1))])
    hit = repeated(rows[used], block + DIGITS)
    row = np.searchsorted(begin, hit, "right") - 1
    spread = last[agree] - first[agree] + 1
    steps = np.arange(spread.sum()) - np.repeat(np.cumsum(spread) - spread, spread)
    part = np.concatenate([of[one[row]], np.repeat(of[agree], spread)])
    window = np.concatenate([first[one[row]] + hit - begin[row], np.repeat(first[agree], spread) + steps])
    found = np.unique(np.stack([part, window]), axis=1)
    return found[0], found[1]


def _sorted_shard(size: int):
    def run(group: pa.Table) -> pa.Table:
        lone = group.column("lone").to_numpy().astype(bool)
        doc, key, low = (group.column(c).to_numpy() for c in ("doc", "key", "low"))
        ahead = group.column("ahead").to_numpy().astype(np.int64)
        part, window = repeated_windows(group.column("part").to_pylist(), ahead, size)
        part, window = part[lone[part]], window[lone[part]]
        new = np.ones(len(part), bool)
        new[1:] = (part[1:] != part[:-1]) | (window[1:] != window[:-1] + 1)
        start = np.flatnonzero(new)
        stop = np.append(start[1:], len(part))[: len(start)] - 1
        owner = part[start]
        columns = (doc[owner], key[owner], low[owner] + window[start], low[owner] + window[stop] + size)
        return pa.table({n: pa.array(c) for n, c in zip(("doc", "key", "a", "b"), columns, strict=True)})

    return run


_CROWDED = "gram long, kind long, whole long, lone boolean, doc long, key long, place long, slot int, n int, left long, right long"


def _packed(data: np.ndarray, start: np.ndarray, size: np.ndarray, width: int, at_end: bool) -> np.ndarray:
    """Up to ``width`` bytes from each start as one number, zeros before them or, without ``at_end``, after."""
    out = np.zeros(len(start), np.int64)
    for k in range(width):
        at = start + k - (width - size if at_end else 0)
        here = (k >= width - size) if at_end else (k < size)
        out = out << 8 | np.where(here, data[np.clip(at, 0, len(data) - 1)], 0)
    return out


def _crowded_blocks(size: int, block: int = BLOCK):
    """Blocks of the segments of anchors too common for a shard, with the bytes left and right of their cores."""

    @hashing.giving_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cut, columns in _part_bytes(batch, size):
                data = np.frombuffer(b"".join(cut), np.uint8)
                sizes = np.array([len(p) for p in cut], np.int64)
                base, ahead = np.cumsum(sizes) - sizes, columns["ahead"].astype(np.int64)
                found = blocks_of(data, base, sizes - size + 1, ahead, size, block)
                of, right = found.of, found.core + size - block + 1
                left_size = found.core - base[of] - found.first
                right_size = base[of] + found.last + size - right
                arrays = {
                    "gram": columns["gram"][of],
                    "kind": found.kind.view(np.int64),
                    "whole": found.whole.view(np.int64),
                    "lone": columns["lone"][of].astype(bool),
                    "doc": columns["doc"][of],
                    "key": columns["key"][of],
                    "place": columns["low"][of] + found.first,
                    "slot": (block - 1 - left_size).astype(np.int32),
                    "n": (found.last - found.first + 1).astype(np.int32),
                    "left": _packed(data, found.core - left_size, left_size, block - 1, True),
                    "right": _packed(data, right, right_size, block - 1, False),
                }
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in arrays.values()], names=list(arrays))

    return run


def _crowded_spans(parts: DataFrame, size: int, block: int = BLOCK) -> DataFrame:
    """(doc, key, a, b) of repeated windows of crowded anchors, by counting; no group is ever in one task.

    Blocks of one whole repeat. Only where blocks of a kind differ are single windows counted, each known by
    anchor, core and the bytes it has left and right of it.
    """
    blocks = materialize(parts.mapInArrow(_crowded_blocks(size, block), _CROWDED), "crowded-blocks")
    same = ["gram", "kind", "whole"]
    classes = materialize(blocks.groupBy(*same).agg(F.count("*").alias("copies")), "crowded-classes")
    rivals = materialize(
        classes.groupBy("gram", "kind").agg(F.count("*").alias("n")).filter("n > 1").select("gram", "kind"),
        "crowded-rivals",
    )
    agree = blocks.filter("lone").join(classes.filter("copies > 1"), same, "left_semi")
    whole = agree.select("doc", "key", F.col("place").alias("a"), (F.col("place") + F.col("n") - 1 + size).alias("b"))
    at = F.expr("explode(sequence(slot, slot + n - 1))").alias("at")
    bits = f"8 * ({block - 1} - at)"
    windows = materialize(
        blocks.join(rivals, ["gram", "kind"], "left_semi")
        .select("gram", "kind", "lone", "doc", "key", "place", "slot", "left", "right", at)
        .withColumn("left", F.expr(f"left & (shiftleft(1L, {bits}) - 1)"))
        .withColumn("right", F.expr(f"shiftright(right, {bits})"))
        .withColumn("a", F.col("place") + F.col("at") - F.col("slot")),
        "crowded-windows",
    )
    window = ["gram", "kind", "at", "left", "right"]
    again = materialize(
        windows.groupBy(*window).agg(F.count("*").alias("n")).filter("n > 1").drop("n"), "crowded-repeats"
    )
    single = windows.filter("lone").join(again, window, "left_semi")
    return whole.union(single.select("doc", "key", "a", (F.col("a") + size).alias("b")))


def spans(documents: DataFrame, size: int = SIZE, crowd: int = CROWD) -> DataFrame:
    """(doc, key, a, b): byte ranges covered by repeated windows; they may touch and overlap."""
    ship(documents.sparkSession)
    texts = _keyed(documents)
    cut_up = texts.filter(F.octet_length("text") >= size).mapInArrow(_segments(size), _SEGMENTS)
    with materialized_for(cut_up, "segments") as found:
        # Written, as the other small sides of joins are: a common anchor's rows are then split among tasks.
        often = found.groupBy("gram").agg(F.sum("times").alias("n")).filter("n > 1")
        common = materialize(often.select("gram"), "common-grams")
        shared = materialize(found.join(common, "gram", "left_semi"), "shared-segments")
    classes = materialize(
        shared.groupBy("gram", "content").agg(
            F.sum("times").alias("copies"), F.min(F.struct("doc", "key", "low", "many", "ahead")).alias("first")
        ),
        "segment-classes",
    )
    rivals = materialize(classes.groupBy("gram").agg(F.count("*").alias("rivals")).filter("rivals > 1"), "rivals")
    contested = materialize(
        classes.join(rivals, "gram").select(
            "gram", "first.*", (F.col("copies") == 1).alias("lone"), "rivals"
        ),
        "contested-segments",
    )
    copies = classes.filter("copies > 1").select("gram", "content")
    whole = shared.join(copies, ["gram", "content"], "left_semi").select(
        "doc", "key", F.col("low").alias("a"), (F.col("low") + F.col("times") * F.col("many") + size - 1).alias("b")
    )
    by_text = contested.groupBy("doc", "key").agg(
        F.collect_list(F.struct("low", "many", "ahead", "gram", "lone", "rivals")).alias("parts")
    )
    # Rows of one id and text send the same segments; more copies of a class that is not lone change nothing.
    cut = texts.join(by_text.hint("shuffle_hash"), ["doc", "key"])

    def parts(which: Column) -> DataFrame:
        return cut.withColumn("parts", F.filter("parts", lambda p: which(p))).filter(F.size("parts") > 0)

    total = contested.filter(F.col("rivals") <= crowd).agg(F.sum(F.col("many") + size)).first()[0] or 0
    shards = int(total // SHARD_BYTES) + 1
    sorted_out = (
        parts(lambda p: p["rivals"] <= crowd)
        .mapInArrow(_texts_of(size), "gram long, lone boolean, ahead int, doc long, key long, low long, part binary")
        .withColumn("shard", F.pmod(F.xxhash64("gram"), F.lit(shards)))
        .groupBy("shard")
        .applyInArrow(_sorted_shard(size), "doc long, key long, a long, b long")
    )
    found = whole.union(sorted_out)
    if not contested.filter(F.col("rivals") > crowd).isEmpty():
        found = found.union(_crowded_spans(parts(lambda p: p["rivals"] > crowd), size))
    return found


def _merged(start: np.ndarray, stop: np.ndarray) -> list[tuple[int, int]]:
    """Ranges that touch or overlap as one."""
    order = np.argsort(start, kind="stable")
    start, stop = start[order], np.maximum.accumulate(stop[order])
    new = np.append(True, start[1:] > stop[:-1])
    return list(zip(start[new].tolist(), stop[np.append(new[1:], True)].tolist(), strict=True))


@hashing.giving_back
def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in hashing.pieces(batch):
            texts, ranges = hashing.as_texts(piece.column("text")), piece.column("ranges")
            flat, lengths = ranges.flatten(), ranges.value_lengths().to_numpy()
            a, b = (flat.field(n).to_numpy() for n in ("a", "b"))
            ends = np.cumsum(lengths)
            removed, many, sha = [], [], []
            for row, (start, stop) in enumerate(zip((ends - lengths).tolist(), ends.tolist(), strict=True)):
                data = texts.data[texts.offsets[row] : texts.offsets[row + 1]].tobytes()
                runs = _merged(a[start:stop], b[start:stop])
                edges = [0, *(x for r in runs for x in r), len(data)]
                rest = b"".join(data[edges[k] : edges[k + 1]] for k in range(0, len(edges), 2))
                removed.append(len(data) - len(rest))
                many.append(len(runs))
                sha.append(hashlib.sha256(rest).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("doc"),
                    piece.column("key"),
                    pa.array(removed, pa.int64()),
                    pa.array(many, pa.int64()),
                    pa.array(sha, pa.string()),
                ],
                names=["doc", "key", "n_removed", "n_spans", "kept_sha256"],
            )


def cut_texts(documents: DataFrame, size: int = PASSAGE) -> DataFrame:
    """(doc, key, n_removed, n_spans, kept_sha256) of the texts that lose bytes, each once."""
    found = materialize(spans(documents, size), "repeat-spans")
    ranges = found.groupBy("doc", "key").agg(F.collect_list(F.struct("a", "b")).alias("ranges"))
    rows = (
        _keyed(documents)
        .join(ranges.hint("shuffle_hash"), ["doc", "key"])
        .mapInArrow(_cut, "doc long, key long, n_removed long, n_spans long, kept_sha256 string")
    )
    return rows.distinct()


def repeats(documents: DataFrame, size: int = PASSAGE) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) per row."""
    cut = cut_texts(documents, size)
    text = F.coalesce("text", F.lit(""))
    base = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("doc"),
        F.xxhash64("text").alias("key"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        F.sha2(text.cast("binary"), 256).alias("sha"),
    )
    return base.join(cut, ["doc", "key"], "left").select(
        "doc_id",
        "n_bytes",
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("kept_sha256", "sha").alias("kept_sha256"),
    )


@F.pandas_udf(BinaryType())
def _rest(text: pd.Series, ranges: pd.Series) -> pd.Series:
    """What is left of texts without their ranges; nothing for a text that has none."""

    def rest(own: bytes, cut: np.ndarray | None) -> bytes | None:
        if cut is None:
            return None
        runs = _merged(np.array([r["a"] for r in cut]), np.array([r["b"] for r in cut]))
        edges = [0, *(x for r in runs for x in r), len(own)]
        return b"".join(own[edges[k] : edges[k + 1]] for k in range(0, len(edges), 2))

    return pd.Series([rest(*x) for x in zip(text, ranges, strict=True)], dtype=object)


def without_repeats(documents: DataFrame, size: int = PASSAGE) -> DataFrame:
    """The documents with repeated bytes cut from ``text`` (a character cut in two goes whole) and
    ``n_chars``, where there is one, counted anew. No row goes."""
    found = materialize(spans(documents, size), "repeat-spans")
    ranges = found.groupBy("doc", "key").agg(F.collect_list(F.struct("a", "b")).alias("ranges"))
    doc = F.coalesce(documents["doc_id"].cast("long"), F.lit(_NO_ID))
    same = (doc == ranges["doc"]) & (F.xxhash64(documents["text"]) == ranges["key"])
    # The texts move once; those with nothing to cut stay out of Python.
    own = F.when(ranges["ranges"].isNotNull(), documents["text"].cast("binary"))
    rest = _rest(own, ranges["ranges"])
    # What is left of a cut character turns into U+FFFD.
    left = F.replace(F.make_valid_utf8(rest.cast("string")), F.lit("\ufffd"), F.lit(""))
    joined = documents.join(ranges, same, "left")
    kept = [documents[f"`{name}`"] for name in documents.columns]
    cut = joined.select(F.struct(*kept).alias("own"), left.alias("left"))
    columns = []
    for name in documents.columns:
        column = F.col(f"own.`{name}`")
        if name in ("text", "n_chars"):
            changed = F.col("left") if name == "text" else F.length("left").cast("long")
            column = F.when(F.col("left").isNull(), column).otherwise(changed)
        columns.append(column.alias(name))
    return cut.select(*columns)
