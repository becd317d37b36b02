import glob
import os
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from roadpulse.llm import components, hashing, near
from roadpulse.session import scratch_root


def _similar(rng, base, edits):
    words = list(base)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return words


def test_a_dense_group_in_chunks_against_all_pairs(spark, monkeypatch):
    """Many near copies of one text, dealt out over several chunks; no link may be lost."""
    monkeypatch.setattr(near, "CHUNK", 8)
    rng = random.Random(1)
    base = [f"b{n}" for n in range(200)]
    texts = [" ".join(_similar(rng, base, rng.randrange(9))) for _ in range(60)]
    texts += [" ".join(f"u{rng.randrange(10**6)}" for _ in range(50)) for _ in range(20)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in near.near_duplicates(df).collect()}
    sets = [{tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)} for t in texts]
    want = list(range(len(texts)))
    for _ in range(len(texts)):
        for a in range(len(texts)):
            for b in range(a):
                if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                    want[a] = want[b] = min(want[a], want[b])
    assert [got[k] for k in range(len(texts))] == want
    assert len(set(want)) > 21


def test_a_long_chain_moves_few_sets(spark):
    """Texts each near the one before: one group by shared bands, but a set goes only where it has a pair left."""
    rng = random.Random(6)
    words = [f"b{n}" for n in range(120)]
    texts = []
    for _ in range(1500):
        words = _similar(rng, words, 1)
        texts.append(" ".join(words))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in near.near_duplicates(df.repartition(4)).collect()}
    sets = [{tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)} for t in texts]
    want = list(range(len(texts)))
    for b in range(len(texts)):  # links reach at most a few steps back
        for a in range(max(0, b - 30), b):
            if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                want[b] = min(want[b], want[a])
    assert [got[k] for k in range(len(texts))] == want
    folder = scratch_root(spark) + "/roadpulse"
    moved = max(glob.glob(f"{folder}/near-survivors-*"), key=os.path.getmtime)
    assert spark.read.parquet(moved).count() < 25 * len(texts)


def test_a_pair_counts_in_its_first_band_and_in_each_block_once():
    rng = np.random.default_rng(8)
    sig = rng.integers(0, 65536, (1, near.VALUES)).astype(np.uint16).repeat(40, 0)
    for row in sig:
        row[rng.permutation(near.VALUES)[: rng.integers(0, 20)]] = 1
    n = np.full(40, 100)
    bands = sig.reshape(40, near.BANDS, near.ROWS)
    want = {(a, b) for a in range(40) for b in range(a + 1, 40) if (sig[a] == sig[b]).sum() >= near.fewest_matches(85, near.VALUES)}
    found = []
    for nth in range(near.BANDS):
        _, of = np.unique(bands[:, nth], axis=0, return_inverse=True)
        for bucket in range(of.max() + 1):
            members = np.flatnonzero(of == bucket)
            low, high = members[::2], members[1::2]
            for left, right in ((low, None), (high, None), (low, high)):
                for a, others in near.Block(sig, n, left, right, nth).survivors(85):
                    found += [(min(a, b), max(a, b)) for b in others.tolist()]
    assert len(found) == len(set(found)) and set(found) <= want and len(found) > 300
    early = {(a, b) for a, b in want if all((sig[a, :u] == sig[b, :u]).sum() >= f for u, f in near.needed(85))}
    assert set(found) == {(a, b) for a, b in early if (bands[a] == bands[b]).all(1).any()}


def test_components_of_chains_and_stars(spark):
    rng = random.Random(2)
    links = [(n, n + 1) for n in range(40)] + [(100, 100 + n) for n in range(1, 30)] + [(200, 201), (202, 201)]
    rng.shuffle(links)
    links = [p if rng.random() < 0.5 else p[::-1] for p in links]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r["id"]: r["component"] for r in components.components(df).collect()}
    assert got == {n: 0 for n in range(1, 41)} | {n: 100 for n in range(101, 130)} | {201: 200, 202: 200}


def test_posterior_bound_is_the_beta_tail():
    rng = np.random.default_rng(3)
    for seen in (20, 60, 120):
        least = near.fewest_matches(85, seen)
        draws = rng.beta(least + 1, seen - least + 1, 400_000)
        assert (draws >= 0.85).mean() < 1e-4
        assert least > 0 and near.fewest_matches(85, seen + 1) >= least


def test_signatures_estimate_similarity():
    rng = random.Random(4)
    base = [f"b{n}" for n in range(400)]
    texts = hashing.as_texts(pa.array([" ".join(base), " ".join(_similar(rng, base, 8))]))
    found = hashing.words(texts)
    owner, value = hashing.distinct(*hashing.shingles(found, 2, 5))
    cuts = np.searchsorted(owner, np.arange(3))
    sig = near.signatures(value, cuts)
    a, b = set(value[: cuts[1]].tolist()), set(value[cuts[1] :].tolist())
    assert abs((sig[0] == sig[1]).mean() - len(a & b) / len(a | b)) < 0.12


def test_ids_that_repeat_with_other_texts(spark):
    """Rows go, not ids: against all pairs of rows."""
    rng = random.Random(12)

    def text(name, n=60):
        return " ".join(f"{name}{k}" for k in range(n))

    near_copy = text("a").replace("a30", "x")
    rows = [
        (5, text("a"), "first"), (9, near_copy, "near copy of 5"), (9, text("b"), "unique, same id"),
        (7, text("c"), "one text of 7"), (7, text("d"), "another of 7"), (8, text("c"), "copy of 7's"),
        (6, text("d").replace("d30", "y"), "near 7's, smaller id"),
        (3, text("e"), "same row"), (3, text("e"), "same row"), (3, text("e") + "\n", "same set, other text"),
        (4, None, "no text"), (4, None, "no text"), (4, "", "empty"), (None, text("a"), "no id"), (None, None, "neither"),
    ]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string, note string").withColumn("key", F.lit("own"))
    for _ in range(2):
        kept = near.without_near_duplicates(docs.repartition(rng.randint(1, 5)), 80)
        assert kept.columns == docs.columns
        got = sorted((r["doc_id"] or 0, r["note"]) for r in kept.collect())
        want = [(0, "neither"), (0, "no id"), (3, got[2][1]), (4, "empty"), (4, "no text"), (5, "first")]
        want += [(6, "near 7's, smaller id"), (7, "one text of 7"), (9, "unique, same id")]
        assert got == sorted(want) and got[2][1] in ("same row", "same set, other text")
    found = {(r["doc_id"], r["component_id"]) for r in near.near_duplicates(docs, 80).collect()}
    # The groups of 7's two texts stay apart.
    assert {(7, 7), (7, 6), (8, 7), (6, 6), (9, 5), (9, 9)} <= found and (8, 6) not in found
