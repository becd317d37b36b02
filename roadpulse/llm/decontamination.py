"""Benchmark decontamination: passages within a share of edits of a benchmark item.

1. Windows: a text is looked at where SEED of its bytes, lowered, also stand in an item; each such place sets an
   item-sized window so that the seed stands as in the item. Windows of one item that begin within the allowed
   edits of each other must hold SEEDS such places (one run of SEED + SEEDS - 1 equal bytes, or several).
2. The CGK embedding maps edit distance to Hamming distance: a walk over the window puts out the byte it
   stands on and, by a random bit for step and byte, stays or goes on. Bit-sampling LSH compares a few
   sampled steps of window and item; REPEATS walks and samples of their own make the target recall.
3. Candidates are verified by exact edit distance of the item to any part of the window's surroundings.

Items of fewer than SHORT bytes hold too few seeds. They are cut into one piece more than they may have edits, so
that in every copy one piece stands unchanged, and all places of all pieces are verified: no copy is missed. Items
of fewer than ten characters allow no edit and match where they stand exactly.

Items go to every task in blocks of bounded size, one pass over the texts for each block.

Null and empty texts: no matches; null and empty items: none. A null doc_id is reported as null. Repeated
rows and items are answered each. Long texts are whole. Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm import hashing
from roadpulse.llm.common import ship

SEED = 12
SEEDS = 5
#: Edits allowed, in percent of an item's length.
EDITS = 10
#: Items of fewer bytes are matched by pieces; from here on the seeds find 0.99 and more of the copies.
SHORT = 81
#: Of a piece, as many characters are looked up as the first of these that it has; then all are compared.
LOOKED_UP = (8, 5, 3, 2, 1)
#: Places of pieces that are compared at a time.
PLACES = 500_000
SAMPLED = 2
RECALL = 0.98
#: Chance, at the allowed edits, that a sampled step of two walks agrees; taken low, measured in the tests.
AGREE = 0.45
REPEATS = math.ceil(math.log(1 - RECALL) / math.log(1 - AGREE**SAMPLED))
#: Items are handed out in blocks of about so many bytes.
BLOCK_BYTES = 4_000_000
_TABLE_BITS = 20


def distance(item: str, text: str) -> int:
    """Least edit distance between the item and any part of the text, by bit-parallel dynamic programming."""
    if item in text:
        return 0
    size, masks = len(item), {}
    for k, c in enumerate(item):
        masks[c] = masks.get(c, 0) | 1 << k
    full, high = (1 << size) - 1, 1 << (size - 1)
    up, down, score = full, 0, size
    best = size
    for c in text:
        equal = masks.get(c, 0)
        across = equal | down
        along = (((equal & up) + up) ^ up) | equal
        more = (down | ~(along | up)) & full
        less = up & along
        if more & high:
            score += 1
        elif less & high:
            score -= 1
        more, less = more << 1 & full, less << 1 & full
        up, down = (less | ~(across | more)) & full, more & across
        best = min(best, score)
    return best


@lru_cache(maxsize=1)
def _turns(steps: int) -> np.ndarray:
    """Random bits by repeat, step and byte."""
    return np.random.default_rng(20).integers(0, 2, (REPEATS, steps, 256), np.uint8)


@lru_cache(maxsize=1)
def _letter_values() -> np.ndarray:
    return hashing.mix(np.arange(1, 0x110001, dtype=np.uint64) * np.uint64(hashing.BASE))


def _letters(data: np.ndarray) -> np.ndarray:
    """Code points of UTF-8 bytes, lowered."""
    return np.frombuffer(hashing.LOWER[data].tobytes().decode().encode("utf-32-le"), np.uint32)


class Short:
    """Items by their pieces; an item with k edits allowed has k + 1 of them, one of which no copy has changed."""

    def __init__(self, items: list[tuple[int, str]]):
        self.items = items
        if not items:
            return
        letters = [_letters(np.frombuffer(text.encode(), np.uint8)) for _, text in items]
        self.text = [x.tobytes().decode("utf-32-le") for x in letters]
        self.size = np.array([len(x) for x in letters], np.int64)
        self.allowed = self.size * EDITS // 100
        data, begin = np.concatenate(letters), np.cumsum(self.size) - self.size
        many = self.allowed + 1
        item = np.repeat(np.arange(len(items)), many)
        turn = np.arange(len(item)) - np.repeat(np.cumsum(many) - many, many)
        offset = turn * self.size[item] // many[item]
        length = (turn + 1) * self.size[item] // many[item] - offset
        running = hashing.running_hash(data, _letter_values())
        start = begin[item] + offset
        whole = hashing.range_hash(running, start, start + length)
        head = np.select([length >= n for n in LOOKED_UP], LOOKED_UP)
        #: By number of characters looked up: hashes, where the pieces of each begin, and the pieces.
        self.pieces = {}
        for n in LOOKED_UP:
            some = np.flatnonzero(head == n)
            if len(some):
                seed = hashing.range_hash(running, start[some], start[some] + n)
                order = np.argsort(seed, kind="stable")
                seed, first = np.unique(seed[order], return_index=True)
                some = some[order]
                rows = item[some], offset[some], length[some], whole[some]
                self.pieces[n] = seed, np.append(first, len(some)), rows
        # Bit masks of the first 64 characters, by item and character.
        place = np.arange(len(data)) - np.repeat(begin, self.size)
        early = np.flatnonzero(place < 64)
        key = (np.repeat(np.arange(len(items)), self.size) << 21 | data)[early]
        order = np.argsort(key, kind="stable")
        self.key, first = np.unique(key[order], return_index=True)
        self.mask = np.bitwise_or.reduceat((np.uint64(1) << place[early].astype(np.uint64))[order], first)

    def places(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(text, item, begin of the item) of the places of all pieces, some at a time."""
        running = hashing.running_hash(data, _letter_values())
        for n, (seeds, first, (items, item_offsets, lengths, wholes)) in self.pieces.items():
            start = np.arange(max(len(data) - n + 1, 0))
            seed = hashing.range_hash(running, start, start + n)
            maybe = np.zeros(1 << _TABLE_BITS, bool)
            maybe[seeds >> np.uint64(64 - _TABLE_BITS)] = True
            start = start[maybe[seed >> np.uint64(64 - _TABLE_BITS)]]
            at = np.minimum(np.searchsorted(seeds, seed[start]), len(seeds) - 1)
            known = seeds[at] == seed[start]
            start, at = start[known], at[known]
            many = first[at + 1] - first[at]
            total = np.cumsum(many)
            a = 0
            while a < len(start):
                b = max(a + 1, int(np.searchsorted(total, total[a] - many[a] + PLACES, "right")))
                some = many[a:b]
                entry = np.repeat(first[at[a:b]] - np.cumsum(some) + some, some) + np.arange(some.sum())
                spot = np.repeat(start[a:b], some)
                text = np.searchsorted(offsets, spot, "right") - 1
                inside = spot + lengths[entry] <= offsets[text + 1]
                entry, spot, text = entry[inside], spot[inside], text[inside]
                same = hashing.range_hash(running, spot, spot + lengths[entry]) == wholes[entry]
                entry, spot, text = entry[same], spot[same], text[same]
                yield text, items[entry], spot - item_offsets[entry]
                a = b

    def least(self, data: np.ndarray, item: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """As `distance`, of the first 64 characters of each item to data[low:high], all at a time."""
        row, out = np.arange(len(item)), np.minimum(self.size[item], 64)
        score, last = out.copy(), (out - 1).astype(np.uint64)
        up, down = np.full(len(item), ~np.uint64(0)), np.zeros(len(item), np.uint64)
        one, place = np.uint64(1), low.copy()
        while len(row):
            live = place < high
            if not live.all():
                row, item, place, high, score, last, up, down = (
                    x[live] for x in (row, item, place, high, score, last, up, down)
                )
                continue
            key = item << 21 | data[place]
            at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
            equal = np.where(self.key[at] == key, self.mask[at], np.uint64(0))
            across = equal | down
            along = (((equal & up) + up) ^ up) | equal
            more, less = down | ~(along | up), up & along
            score = score + (more >> last & one).astype(np.int64) - (less >> last & one).astype(np.int64)
            out[row] = np.minimum(out[row], score)
            more, less = more << one, less << one
            up, down = less | ~(across | more), more & across
            place = place + 1
        return out

    def matches(self, texts: hashing.Texts) -> dict[tuple[int, int], int]:
        """Edits by text and number of the item."""
        best: dict[tuple[int, int], int] = {}
        if not self.items or not len(texts.data):
            return best
        data = _letters(texts.data)
        offsets = np.append(0, np.cumsum((texts.data & 0xC0) != 0x80))[texts.offsets]
        for text, item, begin in self.places(data, offsets):
            exact = self.allowed[item] == 0
            for t, k in np.unique(np.stack([text[exact], item[exact]]), axis=1).T.tolist():
                best[t, k] = 0
            text, item, begin = np.unique(np.stack([text[~exact], item[~exact], begin[~exact]]), axis=1)
            edge = self.allowed[item]
            low = np.maximum(offsets[text], begin - edge)
            high = np.minimum(offsets[text + 1], begin + self.size[item] + edge)
            edits = self.least(data, item, low, high)
            for n in np.flatnonzero(edits <= edge).tolist():
                t, k, least = int(text[n]), int(item[n]), int(edits[n])
                if self.size[k] > 64:
                    least = distance(self.text[k], data[low[n] : high[n]].tobytes().decode("utf-32-le"))
                if least <= edge[n]:
                    best[t, k] = min(least, best.get((t, k), least))
        return best


class Index:
    """Items with their seeds, sampled steps and the bytes that their walks put out there."""

    def __init__(self, items: list[tuple[int, str]]):
        self.short = Short([(number, text) for number, text in items if 0 < len(text.encode()) < SHORT])
        self.items = [(number, text) for number, text in items if len(text.encode()) >= SHORT]
        raw = [hashing.LOWER[np.frombuffer(text.encode(), np.uint8)] for _, text in self.items]
        self.size = np.array([len(r) for r in raw], np.int64)
        self.text = [r.tobytes().decode() for r in raw]
        seeds, item, offset = [], [], []
        for k, r in enumerate(raw):
            start = np.arange(len(r) - SEED + 1)
            seeds.append(hashing.range_hash(hashing.running_hash(r), start, start + SEED))
            item.append(np.full(len(start), k))
            offset.append(start)
        if not raw:
            return
        seed, item, offset = np.concatenate(seeds), np.concatenate(item), np.concatenate(offset)
        order = np.argsort(seed, kind="stable")
        self.item, self.offset = item[order], offset[order]
        self.seed, first = np.unique(seed[order], return_index=True)
        self.first = np.append(first, len(seed))
        self.maybe = np.zeros(1 << _TABLE_BITS, bool)
        self.maybe[self.seed >> np.uint64(64 - _TABLE_BITS)] = True
        # Steps spread over a walk of twice the item's length, which ends about at the item's end.
        rng = np.random.default_rng(21)
        share = np.sort(rng.random((REPEATS, SAMPLED)), axis=1)
        self.steps = (share[None] * 2 * self.size[:, None, None]).astype(np.int64)
        data = np.concatenate(raw)
        begin = np.cumsum(self.size) - self.size
        every = np.repeat(np.arange(len(raw)), REPEATS)
        turn = np.tile(np.arange(REPEATS), len(raw))
        self.put_out = np.zeros((len(raw) * REPEATS, SAMPLED), np.uint8)
        place, at = begin[every], np.zeros(len(every), np.int64)
        stop = begin[every] + self.size[every]
        table, steps = _turns(self.walk), self.steps[every, turn]
        for step in range(self.walk):
            byte = np.where(place < stop, data[np.minimum(place, len(data) - 1)], 0)
            for k in range(SAMPLED):
                hit = steps[:, k] == step
                self.put_out[hit, k] = byte[hit]
            place = place + table[turn, step, byte]
        self.put_out = self.put_out.reshape(len(raw), REPEATS, SAMPLED)

    @property
    def walk(self) -> int:
        return int(2 * self.size.max()) + 1

    def windows(self, texts: hashing.Texts, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, item, start) of the windows that share a seed with their item, each once."""
        running = hashing.running_hash(data)
        start = np.arange(len(data) - SEED + 1)
        seed = hashing.range_hash(running, start, start + SEED)
        start = start[self.maybe[seed >> np.uint64(64 - _TABLE_BITS)]]
        at = np.minimum(np.searchsorted(self.seed, seed[start]), len(self.seed) - 1)
        known = self.seed[at] == seed[start]
        start, at = start[known], at[known]
        text = np.searchsorted(texts.offsets, start, "right") - 1
        inside = start + SEED <= texts.offsets[text + 1]
        start, at, text = start[inside], at[inside], text[inside]
        many = self.first[at + 1] - self.first[at]
        entry = np.repeat(self.first[at] - np.cumsum(many) + many, many) + np.arange(many.sum())
        start, text = np.repeat(start, many), np.repeat(text, many)
        item = self.item[entry]
        begin = start - self.offset[entry]
        allowed = self.size[item] * EDITS // 100
        # A window may begin before its text does, or end after it, only as far as edits go.
        fits = (begin >= texts.offsets[text] - allowed) & (
            begin + self.size[item] <= texts.offsets[text + 1] + allowed
        )
        text, item, begin, allowed = text[fits], item[fits], begin[fits], allowed[fits]
        # One number for text, item and begin, far enough apart that the edits reach no other item.
        room = len(data) + 4 * int(self.size.max())
        place = (text * len(self.items) + item) * room + begin + int(self.size.max())
        line = np.sort(place)
        near = np.searchsorted(line, place + allowed, "right") - np.searchsorted(line, place - allowed)
        enough = near >= SEEDS
        text, item, begin = text[enough], item[enough], begin[enough]
        found = np.unique(np.stack([text, item, np.maximum(begin, texts.offsets[text])]), axis=1)
        return found[0], found[1], found[2]

    def similar(self, data: np.ndarray, stop: np.ndarray, item: np.ndarray, start: np.ndarray) -> np.ndarray:
        """Which windows agree with their item at all sampled steps of one of the repeats."""
        out = np.zeros(len(item), bool)
        window = np.repeat(np.arange(len(item)), REPEATS)
        turn = np.tile(np.arange(REPEATS), len(item))
        place = start[window]
        steps = self.steps[item[window], turn]
        wanted = self.put_out[item[window], turn]
        stop, at, table = stop[window], np.zeros(len(window), np.int64), _turns(self.walk)
        step = 0
        while len(window):
            byte = np.where(place < stop, data[np.minimum(place, len(data) - 1)], 0)
            alive = np.ones(len(window), bool)
            due = np.flatnonzero(steps[np.arange(len(window)), at] == step)
            while len(due):  # two samples may fall on one step
                right = byte[due] == wanted[due, at[due]]
                alive[due[~right]] = False
                due = due[right]
                at[due] += 1
                over = at[due] == SAMPLED
                out[window[due[over]]] = True
                alive[due[over]] = False
                due = due[~over]
                due = due[steps[due, at[due]] == step]
            place = place + table[turn, step, byte]
            if not alive.all():
                alive &= ~out[window]
                window, turn, place, stop, at = window[alive], turn[alive], place[alive], stop[alive], at[alive]
                steps, wanted = steps[alive], wanted[alive]
            step += 1
        return out

    def matches(self, texts: hashing.Texts) -> list[list[tuple[int, int]]]:
        """For each text, (item id, edits) of the items it holds."""
        found: list[list[tuple[int, int]]] = [[] for _ in range(len(texts))]
        for (t, k), edits in sorted(self.short.matches(texts).items()):
            found[t].append((self.short.items[k][0], edits))
        if not self.items or len(texts.data) < SEED:
            return found
        data = hashing.LOWER[texts.data]
        text, item, start = self.windows(texts, data)
        near = self.similar(data, texts.offsets[text + 1], item, start)
        text, item, start = text[near], item[near], start[near]
        allowed = self.size[item] * EDITS // 100
        # Windows of one item that overlap within the edits are verified together.
        new = np.ones(len(text), bool)
        new[1:] = (text[1:] != text[:-1]) | (item[1:] != item[:-1]) | (start[1:] - start[:-1] > allowed[1:])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(text))[: len(first)] - 1
        best: dict[tuple[int, int], int] = {}
        for a, b in zip(first, last, strict=True):
            t, k, edge = int(text[a]), int(item[a]), int(allowed[a])
            low = max(texts.offsets[t], start[a] - edge)
            high = min(texts.offsets[t + 1], start[b] + self.size[k] + edge)
            edits = distance(self.text[k], data[low:high].tobytes().decode(errors="ignore"))
            if 100 * edits <= EDITS * len(self.text[k]):
                best[t, k] = min(edits, best.get((t, k), edits))
        for (t, k), edits in sorted(best.items()):
            found[t].append((self.items[k][0], edits))
        return found


_FOUND = pa.list_(pa.struct([("item_id", pa.int64()), ("edits", pa.int64())]))


def _apply(index: Index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in hashing.pieces(batch):
                rows = [
                    [{"item_id": i, "edits": e} for i, e in hits]
                    for hits in index.matches(hashing.as_texts(piece.column("text")))
                ]
                kept = [c if c is not None else [] for c in piece.column("found").to_pylist()]
                joined = [a + b for a, b in zip(kept, rows, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [piece.column("own"), piece.column("text"), pa.array(joined, _FOUND)],
                    names=["own", "text", "found"],
                )

    return run


def blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The items, in blocks of about BLOCK_BYTES by hash; one block is on the driver at a time."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").filter("text is not null")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    many = int(total // BLOCK_BYTES) + 1
    for k in range(many):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(many)) == k).collect()
        yield sorted(((r["item_id"], r["text"]) for r in part), key=lambda x: (x[0] is None, x))


def matched(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Struct ``own`` of the documents' columns and array ``found`` of (item_id, edits)."""
    ship(documents.sparkSession)
    rows = documents.select(
        F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("own"),
        F.col("text").alias("text"),
        F.lit(None).cast("array<struct<item_id:bigint,edits:bigint>>").alias("found"),
    )
    for items in blocks(benchmark):
        rows = rows.mapInArrow(_apply(Index(items)), rows.schema)
    return rows.select("own", F.coalesce("found", F.array().cast("array<struct<item_id:bigint,edits:bigint>>")).alias("found"))


def leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, edits): every document that holds an item, with the least edits."""
    found = matched(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), benchmark)
    return found.select("own.doc_id", F.explode("found").alias("x")).select("doc_id", "x.item_id", "x.edits")


def without_leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no item."""
    return matched(documents, benchmark).filter(F.size("found") == 0).select("own.*")
