import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
from tokenizers import Tokenizer

from roadpulse.llm import packing
from roadpulse.llm.common import table

SF = "/root/testdata/sf0.001"


def test_pieces_have_the_ids_of_the_tokenizer_and_sequences_no_gaps(spark):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = {r["doc_id"]: r["text"] for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()}
    rows = packing.pack(table(spark, SF, "documents")).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    assert by_doc.keys() == texts.keys()
    total = 0
    for doc, pieces in by_doc.items():
        ids = np.array(tokenizer.encode(texts[doc], add_special_tokens=False).ids + [0], "<u4")
        total += len(ids)
        at = 0
        for n, r in enumerate(sorted(pieces, key=lambda r: r["piece"])):
            assert (r["piece"], r["start"]) == (n, at)
            assert n == 0 or r["length"] == packing.LIMIT
            assert r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= packing.LIMIT
    assert len(by_sequence) <= total / packing.LIMIT * 1.02 + 1


def test_plan_against_best_fit_on_documents():
    """As many sequences as best fit decreasing, done one document at a time, opens."""
    rng = random.Random(1)
    for _ in range(40):
        limit = rng.choice([10, 64])
        histogram = {n: rng.randint(1, 30) for n in rng.sample(range(1, limit + 1), rng.randint(1, 8))}
        rooms = []
        for length in sorted(histogram, reverse=True):
            for _ in range(histogram[length]):
                fitting = [r for r in rooms if r >= length]
                if fitting:
                    rooms.remove(min(fitting))
                    rooms.append(min(fitting) - length)
                else:
                    rooms.append(limit - length)
        ranges = packing.plan(histogram, limit)
        used, ranks = defaultdict(list), defaultdict(list)
        for length, low, high, first, offset in ranges:
            ranks[length] += range(low, high)
            for k in range(high - low):
                used[first + k].append((offset, length))
        assert {n: sorted(r) for n, r in ranks.items()} == {n: list(range(c)) for n, c in histogram.items()}
        for places in used.values():
            at = 0
            for offset, length in sorted(places):
                assert offset == at
                at += length
            assert at <= limit
        assert len(used) <= len(rooms)


def test_cut_leaves_the_short_piece_first():
    assert packing.cut(1, 4) == [(0, 1)]
    assert packing.cut(4, 4) == [(0, 4)]
    assert packing.cut(9, 4) == [(0, 1), (1, 4), (5, 4)]
    assert packing.cut(8, 4) == [(0, 4), (4, 4)]


def test_a_frequent_length_is_ranked_in_groups(spark, monkeypatch):
    monkeypatch.setattr(packing, "RANK_GROUP", 10)
    df = spark.createDataFrame([(n, "a b c") for n in range(300)], "doc_id long, text string")
    rows = packing.pack(df, limit=8).collect()
    assert len({(r["sequence_id"], r["offset"]) for r in rows}) == len(rows) == 300
    assert len({r["sequence_id"] for r in rows}) == 150


def test_added_token_and_long_white_space_have_the_ids_of_the_tokenizer(monkeypatch):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))

    def same(text):
        want = tokenizer.encode(text, add_special_tokens=False).ids
        return packing.token_ids(text).tolist() == [*want, packing.END_ID]

    end = "<|endoftext|>"
    assert all(same(t) for t in (end, f"a {end} b", f" {end}\n{end}{end} x", f"a  {end}  b", "<|endoftext |>"))
    assert all(same("a" + c * 1_000_000 + "b c") for c in (" ", "\n"))
    monkeypatch.setattr(packing, "LONG_SPACE", 3)
    rng = random.Random(2)
    letters = [" ", "\n", "\t", "\x1c", "\x85", "\xa0", "\u2003", "\u200b", "\u3000", "a", "1", "'s", end]
    for _ in range(3000):
        weights = [rng.random() ** 3 for _ in letters]
        assert same("".join(rng.choices(letters, weights, k=rng.randint(1, 30))))


def test_white_space_is_that_of_the_pattern():
    split = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).pre_tokenizer.pre_tokenize_str
    for n in range(0x10000):
        if not 0xD800 <= n < 0xE000:
            ends = [b for _, (_, b) in split(f"a{chr(n) * 3}")]
            alone = len(split(f"a{chr(n) * 3}a")) > 2 and 3 in [b for _, (_, b) in split(f"a{chr(n) * 3}!")]
            assert bool(packing.re.fullmatch(packing._SPACE, chr(n))) == (alone and ends == [1, 4]), hex(n)
