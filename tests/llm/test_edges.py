"""Nulls, empty and long texts, repeated rows, empty tables, extra columns: each has its result."""

import pytest
from pyspark.sql import functions as F

from roadpulse.llm import (
    decontamination,
    language,
    language_model,
    licenses,
    near,
    packing,
    pu_quality,
    quality_rules,
    repeats,
    toxicity,
)

LONG = "the quick brown fox jumps over " * 3000
PROSE = "There was once a small house by the river where nobody had lived for many years and rain came in"
ROWS = [
    (1, PROSE, "en"),
    (2, PROSE, None),
    (3, None, "en"),
    (4, "", "fr"),
    (5, " \n\t ", None),
    (None, PROSE + " today", "en"),
    (6, LONG, "en"),
    (7, "Released under the MIT License.\nLicensed under CC BY-NC 4.0.", "en"),
    (7, "Released under the MIT License.\nLicensed under CC BY-NC 4.0.", "en"),
    (8, "1234 5678", "de"),
    (None, None, None),
]
#: Names that the operators use inside, and some that they return.
EXTRA = ["score", "kept", "label", "word", "row", "own", "found", "rep", "key", "doc", "part", "group", "_rest"]


@pytest.fixture(scope="module")
def tables(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, lang string").coalesce(2)
    docs = docs.withColumns({name: F.lit("x") for name in EXTRA}).withColumn("n_chars", F.length("text").cast("long"))
    labels = spark.createDataFrame(
        [(1, 1, 0), (2, 0, 1), (2, 1, 1), (None, 1, 1), (6, None, None), (99, 1, 1)],
        "doc_id long, quality int, toxic int",
    )
    benchmark = spark.createDataFrame([(10, PROSE), (11, None), (12, "short"), (None, LONG[:200])], "item_id long, text string")
    return docs, labels, benchmark


OPERATORS = {
    "quality_rules": lambda d, labels, b: quality_rules.quality_rules(d, labels),
    "pu_quality": lambda d, labels, b: pu_quality.pu_quality(d, labels),
    "licenses": lambda d, labels, b: licenses.license_scan(d),
    "packing": lambda d, labels, b: packing.pack(d),
    "toxicity": lambda d, labels, b: toxicity.toxicity(d, labels),
    "language": lambda d, labels, b: language.identify(d),
    "repeats": lambda d, labels, b: repeats.repeats(d),
    "near": lambda d, labels, b: near.near_duplicates(d),
    "language_model": lambda d, labels, b: language_model.lm_scores(d),
    "decontamination": lambda d, labels, b: decontamination.leaks(d, b),
}


@pytest.mark.parametrize("name", list(OPERATORS))
def test_empty_tables(spark, tables, name, monkeypatch):
    monkeypatch.setattr(language_model, "STEPS", 3)
    nothing = [t.limit(0) for t in tables]
    assert OPERATORS[name](*nothing).count() == 0
    assert OPERATORS[name](tables[0].limit(0), *tables[1:]).count() == 0


def _by_text(rows, *names):
    return sorted(((r["doc_id"], *(r[n] for n in names)) for r in rows), key=lambda r: (r[0] is None, str(r)))


def test_rows_of_all_kinds(spark, tables, monkeypatch):
    monkeypatch.setattr(language_model, "STEPS", 3)
    got = {}
    for name, operator in OPERATORS.items():
        got[name] = operator(*tables).collect()
        if name not in ("packing", "decontamination"):
            assert len(got[name]) == len(ROWS), name
            assert sorted(str(r["doc_id"]) for r in got[name]) == sorted(str(r[0]) for r in ROWS), name
    one = {r["doc_id"]: r for r in got["quality_rules"] if r["doc_id"] is not None}
    assert [one[k]["n_words"] for k in (3, 4, 5, 8)] == [0, 0, 0, 2] and one[3]["base_failed"] and not one[3]["kept"]
    assert one[6]["n_repeat_words"] == one[6]["n_words"] == 18000
    assert all(0 <= r["score"] <= 1 for r in got["pu_quality"] + got["toxicity"] + got["language"])
    assert {r["score"] for r in got["toxicity"]} == {toxicity.NOTHING}
    assert [r["labels"] for r in got["licenses"] if r["doc_id"] == 7] == ["cc-by-nc,mit"] * 2
    assert {(r["n_words"], r["labels"], r["score"]) for r in got["licenses"] if r["doc_id"] in (3, 4, 5)} == {(0, "", 0.0)}
    by_id = {r["doc_id"]: r for r in got["language"] if r["doc_id"] is not None}
    assert {by_id[k]["lang_pred"] for k in (3, 4, 5, 8)} == {"und"}
    lm = {r["doc_id"]: r for r in got["language_model"] if r["doc_id"] is not None}
    assert lm[3]["n_tokens"] == lm[4]["n_tokens"] == lm[5]["n_tokens"] == 1 and lm[6]["n_tokens"] == 18001
    assert [r["length"] for r in got["packing"] if r["doc_id"] in (3, 4)] == [1, 1]
    assert len([r for r in got["packing"] if r["doc_id"] == 7]) == 2
    assert sum(r["length"] for r in got["packing"] if r["doc_id"] == 6) > packing.LIMIT
    cut = {r["doc_id"]: r for r in got["repeats"] if r["doc_id"] is not None}
    assert (cut[3]["n_bytes"], cut[3]["n_removed"], cut[3]["n_spans"]) == (0, 0, 0)
    assert cut[6]["n_removed"] == cut[6]["n_bytes"] == len(LONG) and cut[6]["n_spans"] == 1
    assert cut[1]["n_removed"] == 0
    close = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in got["near"] if r["doc_id"] is not None}
    assert close[1] == (16, 1, True) and close[2] == (16, 1, False)
    assert close[3] == (0, 3, True) and close[4] == (0, 4, True) and close[8] == (1, 8, True)
    assert close[7] == (6, 7, True)
    assert {(r["component_id"], r["kept"]) for r in got["near"] if r["doc_id"] is None} == {(None, True)}
    hits = {(r["doc_id"], r["item_id"]) for r in got["decontamination"]}
    assert hits == {(1, 10), (2, 10), (None, 10), (6, None)}


def test_filters_keep_the_columns(spark, tables):
    docs, labels, benchmark = tables
    kept = near.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.select("doc_id").collect()) == sorted(
        str(i) for i in (1, 3, 4, 5, 6, 7, 8, None, None)
    )
    cut = repeats.without_repeats(docs)
    assert cut.columns == docs.columns and cut.count() == len(ROWS)
    texts = {r["doc_id"]: (r["text"], r["n_chars"]) for r in cut.collect() if r["doc_id"] is not None}
    assert texts[6] == ("", 0) and texts[1] == (PROSE, len(PROSE)) and texts[3] == (None, None)
    clean = decontamination.without_leaks(docs, benchmark)
    assert clean.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in clean.select("doc_id").collect()) == ["3", "4", "5", "7", "7", "8", "None"]
    scored = pu_quality.classify(docs, labels)
    assert scored.select("own.*").columns == docs.columns and scored.count() == len(ROWS)


def test_own_columns_named_like_a_result_stay(spark, tables):
    docs, labels, _ = tables
    own = docs.withColumns({c: F.lit(7.5) for c in ("quality_score", "score", "own")})
    kept = pu_quality.accepted(own, labels)
    assert kept.columns == own.columns and kept.count()
    assert {(r["quality_score"], r["score"], r["own"]) for r in kept.collect()} == {(7.5, 7.5, 7.5)}
