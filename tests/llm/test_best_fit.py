"""The tree against a plain search, and packed windows against the tokenizer."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from roadpulse.llm import best_fit, packing
from roadpulse.llm.common import table

SF = "/root/testdata/sf0.001"


def test_tree_finds_the_tightest_room():
    rng = random.Random(1)
    for limit in (1, 7, 64, 100, 2048):
        tree, rooms = best_fit.RoomTree(limit), []
        for _ in range(800):
            least = rng.randint(1, limit)
            want = min((r for r in rooms if r >= least), default=None)
            got = tree.tightest(least)
            assert got == want
            if got is not None and rng.random() < 0.6:
                tree.take(got)
                rooms.remove(got)
            if rng.random() < 0.7:
                room = rng.randint(1, limit)
                tree.put(room, 0)
                rooms.append(room)


def _plain_best_fit(lengths, limit):
    rooms, windows = [], []
    for piece, length in enumerate(lengths):
        fits = [k for k, r in enumerate(rooms) if r >= length]
        if not fits:
            rooms.append(limit)
            windows.append([])
            fits = [len(rooms) - 1]
        at = min(fits, key=lambda k: rooms[k])
        rooms[at] -= length
        windows[at].append(piece)
    return rooms, windows


def test_best_fit_decreasing_as_by_hand():
    rng = random.Random(2)
    for limit in (10, 64, 2048):
        for top in (limit // 3, limit):
            lengths = sorted((rng.randint(1, top) for _ in range(300)), reverse=True)
            rooms, windows = _plain_best_fit(lengths, limit)
            got = best_fit.best_fit(lengths, limit)
            # Which of equally full windows is taken may differ; how full they get does not.
            fill = sorted(sum(lengths[p] for p in w) for w in got)
            assert fill == sorted(limit - r for r in rooms) and len(got) == len(windows)


@pytest.mark.parametrize("limit", [2048, 64, 100])
def test_settled_sequences_have_no_padding(limit):
    rng = random.Random(3)
    cases = [[limit // 2 + 1] * 50, [limit - 1] * 33, [3], [1] * 5, [limit], [], [limit // 2 + 3, 5, 7] * 20]
    cases += [[rng.randint(1, limit) for _ in range(rng.randint(1, 200))] for _ in range(40)]
    for lengths in cases:
        lengths = sorted(lengths, reverse=True)
        done = best_fit.settle(best_fit.best_fit(lengths, limit), lengths, limit)
        got = defaultdict(list)
        for sequence in done:
            size = sum(n for _, _, n in sequence)
            assert 0 < size <= limit and (size == limit or size.bit_count() == 1)
            assert all(n > 0 for _, _, n in sequence)
            for piece, start, n in sequence:
                got[piece].append((start, n))
        for piece, length in enumerate(lengths):
            at = 0
            for start, n in sorted(got[piece]):
                assert start == at
                at += n
            assert at == length


def test_parts_of_long_texts_give_the_same_ids():
    rng = random.Random(4)
    for _ in range(60):
        text = "".join(rng.choices("ab1 '!.\n\t\x1c\x85　é語<|endoftext|>s", k=300))
        whole = packing.token_ids(text)[:-1].tolist()
        for part in (1, 7, 50):
            assert best_fit.token_ids(text, part=part).tolist() == [*whole, best_fit.END_ID]


def _check(rows, texts):
    """Rows of pieces against the ids of (doc_id, text): each id once, gapless sequences, checksums, no padding."""
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = defaultdict(list)
    for doc, text in texts:
        want[doc].append([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1])
    pieces = defaultdict(list)
    sequences = defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(pieces) == set(want)
    for doc, lists in want.items():
        found = sorted((r["doc_tokens"], r["start"], r["length"], r["ids_crc32"]) for r in pieces[doc])
        assert sum(n for _, _, n, _ in found) == sum(map(len, lists))
        if len(lists) == 1:
            ids, at = lists[0], 0
            for total, start, n, crc in found:
                assert total == len(ids) and start == at
                assert crc == zlib.crc32(np.array(ids[start : start + n], "<u4").tobytes())
                at += n
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= best_fit.LIMIT and at.bit_count() == 1


def test_documents_against_the_tokenizer(spark):
    docs = table(spark, SF, "documents")
    rows = best_fit.window_digests(docs).collect()
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    _check(rows, texts)
    # No more sequences than tokens need, but for the powers of two of the last one.
    tokens = sum(r["length"] for r in rows)
    assert len({r["sequence_id"] for r in rows}) <= -(-tokens // best_fit.LIMIT) + 11
    # Few documents are cut that fit one window.
    cut = [r for r in rows if r["doc_tokens"] <= best_fit.LIMIT and r["length"] < r["doc_tokens"]]
    assert len(cut) < 60


def test_rows_of_all_kinds_over_many_shards(spark, monkeypatch):
    monkeypatch.setattr(best_fit, "SHARD_TOKENS", 3000)
    rng = random.Random(6)
    rows = [(k, " ".join(rng.choices(["one", "two", "drei", "<|endoftext|>", "x" * 40], k=rng.randint(0, 900)))) for k in range(60)]
    rows += [(60, None), (61, ""), (None, "no id"), (None, None), (62, "twice"), (62, "twice"), (63, "long text " * 20_000)]
    rows += [(64, " " * 5000), (65, "語" * 9000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs = docs.withColumns({c: F.lit("x") for c in ("shard", "ids", "length", "start", "sequence_id")})
    got = best_fit.pack_windows(docs).collect()
    _check(got, rows)
    for r in got:
        ids = np.frombuffer(r["ids"], best_fit.ID)
        assert len(ids) == r["length"] and best_fit.checksum(ids) == r["ids_crc32"]
    assert len({r["sequence_id"] >> 31 for r in got if r["sequence_id"] >= 0}) > 3
    assert best_fit.window_digests(docs.limit(0)).count() == 0
