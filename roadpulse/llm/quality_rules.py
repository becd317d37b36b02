"""Quality rules: hashed n-gram log-likelihood ratio of trusted target against raw corpus.

Words and pairs of neighbouring words are hashed into a fixed number of bins. Two multinomials are
counted over the bins: one over the trusted documents, one over the whole corpus. A document's score
is the mean, over its n-grams, of the log ratio of the two; one fixed threshold decides. Log ratios
are whole numbers of millionths, so sums do not depend on order. DataFrame functions only.

Nulls, empty texts: no words, base_failed, not kept. A null doc_id is kept as null. Repeated rows are
scored each. Long texts are one row's arrays, linear in their length. Extra columns are ignored.
Empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import WORD, labelled

BINS = 10_000
#: Mean log ratio in millionths from which a document is kept.
THRESHOLD = -70_000
SYMBOL = "[#*$%&|<>]"


def _with_words(documents: DataFrame) -> DataFrame:
    """Words of each text, and the crc32 of each word as its id."""
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(WORD), F.lit(0))
    found = documents.select("doc_id", "text", words.alias("words"))
    return found.withColumn("ids", F.transform("words", lambda w: F.crc32(w.cast("binary"))))


def _bin(word: Column) -> Column:
    return F.pmod(word, F.lit(BINS)).cast("int")


def _pair_bin(word: Column, after: Column) -> Column:
    """Null after the last word."""
    return F.pmod(word * 31 + after, F.lit(BINS)).cast("int")


def _grams(ids: Column) -> Column:
    """Bins of the words, then of the pairs."""
    pairs = F.transform(ids, lambda w, i: _pair_bin(w, F.get(ids, i + 1)))
    return F.concat(F.transform(ids, _bin), F.slice(pairs, 1, F.greatest(F.size(ids) - 1, F.lit(0))))


def weights(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """One row: array of the log ratios of all bins, in millionths, with add-one smoothing."""
    spark = documents.sparkSession
    trusted = labelled(labels, "quality").filter("mark = 1").select("doc_id", F.lit(1).alias("trusted"))
    # One plan for tables of every size: texts are exchanged, not their words, which are longer, and not sorted.
    joined = documents.select("doc_id", "text").join(trusted.hint("shuffle_hash"), "doc_id", "left")
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(WORD), F.lit(0))
    flagged = joined.select(F.transform(words, lambda w: F.crc32(w.cast("binary"))).alias("ids"), "trusted")
    counts = (
        flagged.select(F.explode(_grams(F.col("ids"))).alias("bin"), "trusted")
        .groupBy("bin")
        .agg(F.count("*").alias("raw"), F.count("trusted").alias("good"))
    )
    every = spark.range(BINS).select(F.col("id").cast("int").alias("bin")).join(counts, "bin", "left")
    rows = every.agg(
        F.sort_array(
            F.collect_list(
                F.struct("bin", F.coalesce("raw", F.lit(0)).alias("raw"), F.coalesce("good", F.lit(0)).alias("good"))
            )
        ).alias("bins"),
        F.coalesce(F.sum("raw"), F.lit(0)).alias("raw_all"),
        F.coalesce(F.sum("good"), F.lit(0)).alias("good_all"),
    )
    return rows.select(
        F.transform(
            "bins",
            lambda b: F.round(
                F.lit(1e6)
                * (
                    F.log((b["good"] + 1) / (F.col("good_all") + BINS))
                    - F.log((b["raw"] + 1) / (F.col("raw_all") + BINS))
                )
            ).cast("long"),
        ).alias("weights")
    )


def _repeat_words(words: Column, windows: Column) -> Column:
    """Words that lie in a five-word window found twice or more: windows sorted by hash bring equal
    ones together; the places found, in order, are then covered from left to right."""
    same = lambda w, i: (
        w["hash"].eqNullSafe(F.get(windows, i - 1)["hash"]) | w["hash"].eqNullSafe(F.get(windows, i + 1)["hash"])
    )
    places = F.sort_array(F.transform(F.filter(windows, same), lambda w: w["at"]))
    covered = F.aggregate(
        places,
        F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("words")),
        lambda a, at: F.struct(
            (at + 5).alias("end"), (a["words"] + at + 5 - F.greatest(a["end"], at)).alias("words")
        ),
        lambda a: a["words"],
    )
    return F.when(windows.isNull(), F.lit(0).cast("long")).otherwise(covered)


def quality_rules(documents: DataFrame, labels: DataFrame) -> DataFrame:
    model = weights(documents, labels)
    words, hashes = F.col("words"), F.col("hashes")
    hash5 = lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(5)])
    at = F.sequence(F.lit(0), F.size(words) - 5)
    empty = F.array().cast("array<bigint>")
    hashed = _with_words(documents).withColumn(
        "hashes", F.when(F.size(words) >= 5, F.transform(at, hash5)).otherwise(empty)
    )
    windows = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("hash"), i.alias("at"))))
    repeated = F.size(F.array_distinct(hashes)) < F.size(hashes)
    ready = hashed.withColumn("windows", F.when(repeated, windows)).select(
        "*", model.scalar().alias("_weights")
    )
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: F.rlike(line, F.lit(r"[^\x20\x09-\x0D]")))
    ids, weight = F.col("ids"), F.col("_weights")
    gain = F.transform(
        ids,
        lambda w, i: F.get(weight, _bin(w)) + F.coalesce(F.get(weight, _pair_bin(w, F.get(ids, i + 1))), F.lit(0)),
    )
    base = ready.select(
        "doc_id",
        F.size(words).cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(SYMBOL)).cast("long").alias("n_symbols"),
        F.transform(F.array(lines), lambda a: F.size(a) - F.size(F.array_distinct(a)))[0]
        .cast("long")
        .alias("n_dup_lines"),
        _repeat_words(words, F.col("windows")).alias("n_repeat_words"),
        F.aggregate(gain, F.lit(0).cast("long"), lambda a, b: a + b).alias("ratio"),
    )
    n_grams = F.greatest(2 * F.col("n_words") - 1, F.lit(1))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return base.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & (F.col("ratio") >= THRESHOLD * n_grams)).alias("kept"),
        F.col("ratio").alias("log_ratio_millionths"),
    )
