"""The operators as named queries over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from roadpulse.llm.best_fit import window_digests
from roadpulse.llm.common import table
from roadpulse.llm.decontamination import leaks
from roadpulse.llm.filter_audit import filter_audit
from roadpulse.llm.fim import fim_digests
from roadpulse.llm.language import identify
from roadpulse.llm.language_model import lm_scores
from roadpulse.llm.licenses import license_scan
from roadpulse.llm.near import near_duplicates
from roadpulse.llm.packing import pack
from roadpulse.llm.pu_quality import pu_quality
from roadpulse.llm.quality_rules import quality_rules
from roadpulse.llm.repeats import SIZE, repeats
from roadpulse.llm.toxicity import toxicity


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pu_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats(table(spark, sf_dir, "documents"), SIZE)


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op9_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(spark, sf_dir, table(spark, sf_dir, "labels"))


def op12_window_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_digests(table(spark, sf_dir, "documents"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim_digests(table(spark, sf_dir, "documents"))


_ALL = [
    op1_quality_rules,
    op2_pu_quality,
    op3_license_scan,
    op4_packing,
    op5_toxicity,
    op6_language,
    op7_repeats,
    op8_near_duplicates,
    op9_language_model,
    op10_decontamination,
    op11_filter_audit,
    op12_window_packing,
    op13_fill_in_middle,
]


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in _ALL}


def llm_oracles() -> dict[str, str]:
    from roadpulse.llm.oracles import llm_oracles as found

    return {name: sql for name, sql in found().items() if name in llm_queries()}
