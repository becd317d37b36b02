"""Each stage against what its operator says of its own input."""

import random

import corpus_pipeline
from pyspark.sql import functions as F

from roadpulse.llm import decontamination, near, pu_quality, repeats
from roadpulse.llm.common import table

SF = "/root/testdata/sf0.001"


def test_stages_take_effect_in_order(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier",
        "MinHash near-dedup",
        "suffix-array dedup",
        "benchmark decontamination",
        "best-fit packing",
    ]
    docs = table(spark, SF, "documents")
    columns, stages = docs.columns, [f for _, f in corpus_pipeline.STAGES]
    scores = {r["doc_id"]: r["predicted"] for r in pu_quality.pu_quality(docs, table(spark, SF, "labels")).collect()}
    first = stages[0](spark, docs, SF).cache()
    assert {r["doc_id"] for r in first.collect()} == {k for k, v in scores.items() if v}

    second = stages[1](spark, first, SF).cache()
    kept = near.near_duplicates(first, corpus_pipeline.SIMILAR).filter("kept").select("doc_id").collect()
    assert sorted(r["doc_id"] for r in second.collect()) == sorted(r["doc_id"] for r in kept)

    third = stages[2](spark, second, SF).cache()
    removed = {r["doc_id"]: r["n_removed"] for r in repeats.repeats(second).collect()}
    before = {r["doc_id"]: r["text"] for r in second.collect()}
    for r in third.collect():
        lost = len(before[r["doc_id"]].encode()) - len(r["text"].encode())
        # A character cut in two goes whole: up to three more bytes at each end of a span.
        assert removed[r["doc_id"]] <= lost <= removed[r["doc_id"]] * 1.05 + 6
        assert r["n_chars"] == len(r["text"])
    assert third.count() == second.count()

    fourth = stages[3](spark, third, SF).cache()
    leaks = {r["doc_id"] for r in decontamination.leaks(third, table(spark, SF, "benchmark")).collect()}
    assert {r["doc_id"] for r in fourth.collect()} == {r["doc_id"] for r in third.collect()} - leaks
    assert all(df.columns == columns for df in (first, second, third, fourth))

    last = stages[4](spark, fourth, SF)
    assert {r["doc_id"] for r in last.select("doc_id").collect()} == {r["doc_id"] for r in fourth.collect()}
    whole = corpus_pipeline.run(spark, SF)
    assert whole.columns == last.columns
    key = ["doc_id", "piece", "length", "ids_crc32"]
    assert sorted(map(tuple, whole.select(key).collect())) == sorted(map(tuple, last.select(key).collect()))
    assert whole.agg(F.max(F.col("offset") + F.col("length"))).first()[0] <= 2048


def test_near_copies_from_four_fifths_on_go(spark):
    """Against all pairs; among them are pairs that op8's own limit, 85, leaves apart."""
    rng = random.Random(5)
    texts = []
    for group in range(40):
        words = [f"g{group}w{n}" for n in range(200)]
        texts.append(" ".join(words))
        for place in range(rng.randint(1, 5)):
            words[20 + 40 * place] = f"x{group}"
        texts.append(" ".join(words))
    sets = [{tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)} for t in texts]
    alike = [len(a & b) / len(a | b) for a, b in zip(sets[::2], sets[1::2])]
    assert sum(0.8 <= x < 0.85 for x in alike) > 4 and any(x < 0.8 for x in alike)
    want = [n for n in range(len(texts)) if n % 2 == 0 or alike[n // 2] < 0.8]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = corpus_pipeline.near_duplicates(spark, docs, SF)
    assert sorted(r["doc_id"] for r in got.collect()) == want


def test_repeated_passages_of_over_fifty_words_go(spark):
    """Also those shorter than what op7 asks for; no row and nothing else goes."""
    rng = random.Random(6)

    def prose(words):
        return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 7))) for _ in range(words))

    texts, own = [], []
    for group in range(12):
        passage = prose(51 + group)
        for copy in range(2 + group % 3):
            own.append((f"{prose(80)} {copy}", f"{copy} {prose(60)}"))
            texts.append(passage.join(own[-1]))
    assert min(len(t) - len(a) - len(b) for t, (a, b) in zip(texts, own)) < 300
    rows = [(n, t, n % 2, len(t)) for n, t in enumerate(texts)] + [(None, None, 7, None), (90, "", 7, 0), (91, prose(90), 7, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `odd.name` int, n_chars long")
    got = corpus_pipeline.repeated_passages(spark, docs, SF)
    assert got.columns == docs.columns and got.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
    found = {r["doc_id"]: tuple(r) for r in got.collect()}
    assert len(found) == len(rows)
    assert {n: found[n][1] for n in range(len(own))} == {n: a + b for n, (a, b) in enumerate(own)}
    assert all(found[n][2] == n % 2 and found[n][3] == len(found[n][1]) for n in range(len(own)))
    assert [found[r[0]] for r in rows[-3:]] == rows[-3:]
