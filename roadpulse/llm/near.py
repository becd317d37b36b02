"""MinHash near-duplicates with sequential Bayesian verification.

1. Each text becomes its set of distinct five-word shingles (64-bit hashes); equal sets are one class, with a number
   of its own and its smallest doc_id. A signature of MinHash values goes with it.
2. Signatures are cut into bands; classes that share a band are candidates and make a bucket. Buckets with the same
   members are one, that of the first band.
3. A bucket is dealt out in chunks of bounded size; each pair of chunks is one block, to which signatures travel. There,
   pairs are compared by batches of signature values; after each batch, those whose posterior chance of reaching the limit
   is below MISS are dropped. A pair counts in the bucket of its first shared band only.
4. Whole sets travel only for classes with a pair left, and only to the blocks where they have one. There survivors are
   verified, pairs already linked are skipped, and only a spanning forest of the links is written; these make
   the components.

Null and empty texts, or texts without a word: n_shingles 0, linked with nothing. A null doc_id is never
linked: component null, kept true. Rows with the same doc_id and set are one document; with other sets, each row
is answered by its own, and links of one do not become links of the other. Long texts cost their length; extra columns
are ignored; empty tables give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.llm import hashing
from roadpulse.llm.common import ship
from roadpulse.llm.components import components
from roadpulse.session import materialize

SHINGLE = 5
BANDS, ROWS = 24, 5
VALUES = BANDS * ROWS
BATCH = 20
#: A pair is dropped when the chance that it reaches the limit is below this.
MISS = 1e-6
#: Members of a bucket that one side of a block holds, about, and the bytes of their sets.
CHUNK, CHUNK_BYTES = 512, 16 << 20

_MULTIPLIERS = hashing.mix(np.arange(1, VALUES + 1, dtype=np.uint64)) | np.uint64(1)


def fewest_matches(percent: int, seen: int) -> int:
    """Fewest equal values among ``seen`` for which a pair may still reach the limit.

    With a uniform prior the similarity after m matches of n follows Beta(m + 1, n - m + 1); its
    chance to exceed t is that of at most m successes in n + 1 draws of probability t.
    """
    t, total = percent / 100, 0.0
    for m in range(seen + 1):
        total += math.comb(seen + 1, m) * t**m * (1 - t) ** (seen + 1 - m)
        if total >= MISS:
            return m
    return seen


def signatures(value: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Smallest of each hash function over the runs of ``value`` between cuts: the last 16 of its bits, which
    tell unequal ones apart but for one in 65,536."""
    out = np.empty((len(cuts) - 1, VALUES), np.uint16)
    for k in range(VALUES):
        least = np.minimum.reduceat((value * _MULTIPLIERS[k]) >> np.uint64(32), cuts[:-1])
        out[:, k] = least & np.uint64(0xFFFF)
    return out


def _sets(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Shingles ordered by text, and where each text's begin and end."""
    texts = hashing.as_texts(batch.column("text"))
    found = hashing.words(texts)
    owner, value = hashing.distinct(*hashing.shingles(found, len(texts), SHINGLE))
    return value, np.searchsorted(owner, np.arange(len(texts) + 1))


def _fixed(rows: np.ndarray) -> pa.Array:
    """Rows of a matrix as binary values."""
    width = rows.shape[1] * rows.itemsize
    ends = np.arange(len(rows) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(
        pa.binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(rows))]
    )


def _prints(value: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Each whole set in 128 bits: two sums of independent hashes of its members."""
    salted = (hashing.mix(value + np.uint64(k + 1)) for k in range(2))
    return np.stack([np.add.reduceat(x, starts).view(np.int64) for x in salted], axis=1)


@hashing.giving_back
def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in hashing.pieces(batch):
            value, cuts = _sets(piece)
            size = np.diff(cuts)
            full = np.flatnonzero(size)
            starts = cuts[:-1][full]
            sig, prints = np.zeros((len(size), VALUES), np.uint16), np.zeros((len(size), 2), np.int64)
            if len(full):
                sig[full] = signatures(value, np.append(starts, len(value)))
                prints[full] = _prints(value, starts)
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("doc_id"),
                    piece.column("key"),
                    pa.array(size.astype(np.int64)),
                    pa.array(prints[:, 0]),
                    pa.array(prints[:, 1]),
                    _fixed(sig),
                ],
                names=["doc_id", "key", "n", "print1", "print2", "sig"],
            )


def _bands() -> Column:
    """Hashes of a signature's bands, in order."""
    width = 2 * ROWS
    return F.array(*[F.xxhash64(F.lit(k), F.substring("sig", k * width + 1, width)) for k in range(BANDS)])


@hashing.giving_back
def _set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole set of each text that has one."""
    for batch in batches:
        for piece in hashing.pieces(batch):
            value, cuts = _sets(piece)
            full = np.flatnonzero(np.diff(cuts))
            if not len(full):
                continue
            cuts = np.append(cuts[:-1][full], len(value))
            ends = (cuts * value.itemsize).astype(np.int32)
            sets = pa.Array.from_buffers(
                pa.binary(), len(full), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(value))]
            )
            prints = _prints(value, cuts[:-1])
            columns = [piece.column("rep").take(pa.array(full)), pa.array(np.diff(cuts).astype(np.int64))]
            columns += [pa.array(prints[:, 0]), pa.array(prints[:, 1]), sets]
            yield pa.RecordBatch.from_arrays(columns, names=["rep", *_SET, "shingles"])


class _Forest:
    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)
        return a != b


class Block:
    """Two chunks of a bucket's members, or one with itself; ``nth`` is the band they share."""

    def __init__(self, sig: np.ndarray, n: np.ndarray, left: np.ndarray, right: np.ndarray | None, nth: int):
        self.sig, self.n, self.left, self.right, self.nth = sig, n, left, right, nth

    def survivors(self, percent: int) -> Iterator[tuple[int, np.ndarray]]:
        """Members with those they may reach the limit with and share no earlier band with; each pair once."""
        sig, n, least = self.sig, self.n, needed(percent)
        for k, a in enumerate(self.left):
            others = self.left[k + 1 :] if self.right is None else self.right
            others = others[100 * np.minimum(n[others], n[a]) >= percent * np.maximum(n[others], n[a])]
            matches = np.zeros(len(others), np.int64)
            for upto, fewest in least:
                if not len(others):
                    break
                matches += (sig[others, upto - BATCH : upto] == sig[a, upto - BATCH : upto]).sum(1)
                others, matches = others[matches >= fewest], matches[matches >= fewest]
            if len(others) and self.nth:
                same = sig[others, : self.nth * ROWS] == sig[a, : self.nth * ROWS]
                others = others[~same.reshape(len(others), self.nth, ROWS).all(2).any(1)]
            if len(others):
                yield int(a), others

    def links(self, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
        """Spanning forest of the links."""
        forest, found = _Forest(len(self.n)), []
        for a, others in self.survivors(percent):
            for b in others:
                if forest.root(a) != forest.root(b):
                    shared = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
                    if 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
                        forest.join(a, b)
                        found.append((a, int(b)))
        return found


@lru_cache
def needed(percent: int) -> list[tuple[int, int]]:
    """Values seen, and the fewest equal ones among them, for each batch."""
    return [(upto, fewest_matches(percent, upto)) for upto in range(BATCH, VALUES + 1, BATCH)]


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Rows that agree in ``keys``, from batches ordered by them."""
    rows, key = [], None
    for batch in batches:
        values = np.stack([batch.column(k).to_numpy() for k in keys], axis=1).astype(np.int64)
        cuts = np.flatnonzero((values[1:] != values[:-1]).any(1)) + 1
        for low, high in zip([0, *cuts], [*cuts, len(values)]):
            if low == high:
                continue
            if rows and tuple(values[low]) != key:
                yield pa.Table.from_batches(rows)
                rows = []
            key = tuple(values[low])
            rows.append(batch.slice(low, high - low))
    if rows:
        yield pa.Table.from_batches(rows)


def _block(rows: pa.Table) -> Block:
    low, high, nth = (rows.column(c)[0].as_py() for c in ("low", "high", "nth"))
    own = rows.column("chunk").to_numpy()
    sig = np.frombuffer(b"".join(rows.column("sig").to_pylist()), np.uint16).reshape(-1, VALUES)
    right = None if low == high else np.flatnonzero(own == high)
    return Block(sig, rows.column("n").to_numpy(), np.flatnonzero(own == low), right, nth)


def _gathered(tables: Iterator[pa.Table], most: int = 10_000) -> Iterator[pa.RecordBatch]:
    """The rows of many small tables in fewer batches."""
    held, n = [], 0
    for table in tables:
        held.append(table)
        n += table.num_rows
        if n >= most:
            yield from pa.concat_tables(held).combine_chunks().to_batches()
            held, n = [], 0
    if n:
        yield from pa.concat_tables(held).combine_chunks().to_batches()


_BLOCK = ["nth", "band", "low", "high"]


def _with_survivors(percent: int):
    """Members of each block that have a pair left there."""

    def kept(rows: pa.Table) -> pa.Table:
        stays = np.zeros(rows.num_rows, bool)
        for a, others in _block(rows).survivors(percent):
            stays[a] = stays[others] = True
        return rows.select([*_BLOCK, "chunk", "node"]).filter(pa.array(stays))

    @hashing.giving_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _gathered(kept(rows) for rows in runs(batches, _BLOCK))

    return run


def _verified(percent: int):
    def links(rows: pa.Table) -> pa.Table:
        # An id on several rows brings its set as often.
        first = np.unique(rows.column("node").to_numpy(), return_index=True)[1]
        rows = rows.take(pa.array(first))
        node = rows.column("node").to_numpy()
        sets = [np.frombuffer(x, np.uint64) for x in rows.column("shingles").to_pylist()]
        found = np.array(_block(rows).links(sets, percent), np.int64).reshape(-1, 2)
        return pa.table({"a": node[found[:, 0]], "b": node[found[:, 1]]})

    @hashing.giving_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _gathered(links(rows) for rows in runs(batches, _BLOCK))

    return run


_SET = ["n", "print1", "print2"]


def _by_block(rows: DataFrame) -> DataFrame:
    """Each block's rows in one task, one after the other."""
    return rows.repartition(*_BLOCK).sortWithinPartitions(*_BLOCK)


def answers(documents: DataFrame, percent: int) -> DataFrame:
    """(doc_id, key, n, print1, print2, component, least) per row. ``key`` is a hash of the text, ``component`` the smallest
    doc_id of the texts linked with it, and ``least`` whether its set is the first of those that id has among them."""
    ship(documents.sparkSession)
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("key"), "text")
    rows = materialize(
        texts.mapInArrow(_digest, "doc_id long, key long, n long, print1 long, print2 long, sig binary"), "near-digest"
    )
    # Copies meet here, before anything is compared; their signatures are the same.
    classes = materialize(
        rows.filter("doc_id is not null and n > 0")
        .groupBy(*_SET)
        .agg(F.min("doc_id").alias("rep"), F.first("sig").alias("sig"))
        .withColumn("node", F.monotonically_increasing_id()),
        "near-classes",
    )
    bands = classes.select("node", "n", F.posexplode(_bands()).alias("nth", "band"))
    members = [F.bit_xor(F.xxhash64("node", F.lit(k))).alias(f"members{k}") for k in range(2)]
    shared = bands.groupBy("nth", "band").agg(F.count("*").alias("m"), F.sum("n").alias("total"), *members).filter("m > 1")
    # Near copies share many bands; buckets of the same members are compared once, in that of the first band.
    chunks = F.greatest(F.ceil(F.col("m") / CHUNK), F.ceil(8 * F.col("total") / CHUNK_BYTES)).cast("int")
    buckets = materialize(
        shared.groupBy("m", "total", "members0", "members1")
        .agg(F.min(F.struct("nth", "band")).alias("first"))
        .select("first.*", chunks.alias("chunks")),
        "near-buckets",
    )
    blocks = (
        bands.join(buckets, ["nth", "band"])
        .withColumn("chunk", F.pmod(F.hash("node"), "chunks"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .withColumn("low", F.least("chunk", "other"))
        .withColumn("high", F.greatest("chunk", "other"))
        .select(*_BLOCK, "chunk", "node")
    )
    layout = "nth int, band long, low int, high int, chunk int, node long"
    survivors = materialize(
        _by_block(blocks.join(classes.select("node", "n", "sig"), "node")).mapInArrow(_with_survivors(percent), layout),
        "near-survivors",
    )
    chosen = materialize(
        classes.join(survivors.select("node").distinct(), "node", "left_semi").select("node", "rep", *_SET, "sig"),
        "near-candidates",
    )
    sets = (
        texts.select(F.col("doc_id").alias("rep"), "text")
        .join(chosen.select("rep").hint("shuffle_hash"), "rep", "left_semi")
        .mapInArrow(_set_rows, "rep long, n long, print1 long, print2 long, shingles binary")
        .join(chosen, ["rep", *_SET])
        .select("node", "n", "sig", "shingles")
    )
    links = materialize(
        _by_block(survivors.join(sets, "node")).mapInArrow(_verified(percent), "a long, b long"), "near-links"
    )
    linked = components(links, "near-components")
    members = linked.union(linked.select("component", "component").distinct()).toDF("node", "of")
    first = F.struct("rep", *_SET)
    named = materialize(members.join(classes.select("node", first.alias("own")), "node"), "near-members")
    leasts = materialize(named.groupBy("of").agg(F.min("own").alias("first")), "near-leasts")
    found = materialize(
        named.join(leasts, "of").select(
            *[F.col(f"own.{c}").alias(c) for c in _SET],
            F.col("first.rep").alias("component"),
            (F.col("own") == F.col("first")).alias("least"),
        ),
        "near-named",
    )
    alone = classes.select(*_SET, F.col("rep").alias("own"))
    answered = rows.drop("sig").join(alone, _SET, "left").join(found, _SET, "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "own", "doc_id"))
    return answered.select("doc_id", "key", *_SET, component.alias("component"), F.coalesce("least", F.lit(True)).alias("least"))


def near_duplicates(documents: DataFrame, percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row; linked where 100 * intersection >= percent * union."""
    return answers(documents, percent).select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.col("component").alias("component_id"),
        F.coalesce(F.col("doc_id") == F.col("component"), F.lit(True)).alias("kept"),
    )


def without_near_duplicates(documents: DataFrame, percent: int = 85) -> DataFrame:
    """One row of each component stays: of the smallest doc_id, there of its first set, and of rows with
    both the one of smallest hash of all its columns. Rows without words or doc_id stay, but for repeats of an id with the
    same text. Another text of an id that goes is judged by itself."""
    judged = materialize(answers(documents, percent).filter("doc_id is not null"), "near-judged")
    stays = judged.filter((F.col("doc_id") == F.col("component")) & F.col("least"))
    # Texts with one set may differ in white space; of those of an id, one.
    chosen = F.when(F.col("n") > 0, F.lit(0)).otherwise(F.col("key"))
    kept = stays.groupBy("doc_id", *_SET, chosen.alias("apart")).agg(F.min("key").alias("key"))
    own = F.struct(*[F.col(f"`{c}`") for c in documents.columns])
    rows = documents.filter("doc_id is not null").select(
        own.alias("own"), F.col("doc_id").cast("long").alias("doc"), F.xxhash64("text").alias("key")
    )
    rows = rows.join(kept.select(F.col("doc_id").alias("doc"), "key").distinct(), ["doc", "key"], "left_semi")
    single = rows.groupBy("doc", "key").agg(F.min_by("own", F.xxhash64("own")).alias("own"))
    return single.select("own.*").unionByName(documents.filter("doc_id is null"))
