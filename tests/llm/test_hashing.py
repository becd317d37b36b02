import random
import re

import numpy as np
import pyarrow as pa

from roadpulse.llm import hashing


def _lower(word):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in word)


def _texts(n=200, seed=1):
    rng = random.Random(seed)
    letters = "ab C\tdé ß\n日. \x0b\x00"
    return ["".join(rng.choice(letters) for _ in range(rng.randrange(40))) for _ in range(n)]


def test_words_are_those_of_the_pattern():
    texts = _texts()
    found = hashing.words(hashing.as_texts(pa.array(texts)))
    want = [(k, _lower(w)) for k, t in enumerate(texts) for w in re.findall(r"[^\x20\x09-\x0D]+", t)]
    assert found.text.tolist() == [k for k, _ in want]
    names = {}
    for (_, word), h in zip(want, found.hash.tolist()):
        assert names.setdefault(word, h) == h
    assert len(set(names.values())) == len(names)


def test_shingles_are_windows_or_the_whole():
    texts = ["a b c d e f", "a b c d e", "a b", "a  b", "b a", "", " ", "a b c d e f"]
    found = hashing.words(hashing.as_texts(pa.array(texts)))
    owner, value = hashing.distinct(*hashing.shingles(found, len(texts), 5))
    sets = [set(value[owner == k].tolist()) for k in range(len(texts))]
    assert [len(s) for s in sets] == [2, 1, 1, 1, 1, 0, 0, 2]
    assert sets[0] == sets[7] and sets[1] < sets[0] and sets[2] == sets[3] != sets[4]


def test_hashes_do_not_depend_on_the_batch(monkeypatch):
    texts = _texts(50, 2) + [None, "x " * 500]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])

    def hashes():
        parts = list(hashing.pieces(batch))
        assert sum(p.num_rows for p in parts) == len(texts)
        return np.concatenate([hashing.words(hashing.as_texts(p.column("text"))).hash for p in parts])

    whole = hashes()
    monkeypatch.setattr(hashing, "PIECE_BYTES", 64)
    assert (hashes() == whole).all()
