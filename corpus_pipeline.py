"""Cleaning of a corpus, stage by stage: quality rules, near-duplicates, repeated passages, personal data, packing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relocate.llm import minhash, packing, pii, quality, substring
from relocate.llm.queries import PII_KEY, TOKENIZER
from relocate.session import saved


def _private(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` under names that no operator uses, and which name each column has now."""
    names = [f"_own_{i}" for i in range(len(docs.columns))]
    return docs.toDF(*names), dict(zip(docs.columns, names))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, without the lines that fail them."""
    own, name = _private(docs)
    # the row number keeps the filter above the verdict, which would be worked out twice below it
    judged = quality.judged(own, text_col=name["text"]).withColumn("_row", F.monotonically_increasing_id()).filter("kept AND _row >= 0")
    return judged.select(*[judged["clean_text" if c == name["text"] else c] for c in own.columns]).toDF(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that resembles each other in four of five words in a row or more.

    Rows are grouped, not ids: of rows with equal ids, or without, one stays like of any others. It is that of the least
    id. Documents without words stay.
    """
    own, name = _private(docs)
    number, text = name["doc_id"], name["text"]
    # saved, so that a row has the same number whenever it is read
    rows = saved(own.withColumn("_row", F.monotonically_increasing_id()), "numbered-rows")
    groups = minhash.near_duplicates(rows, shingle=5, percent=80, id_col="_row", text_col=text).select("_row", "component_id")
    named = groups.join(rows.select("_row", number), "_row")
    first = F.min(F.struct(F.col(number).isNull().alias("unnamed"), number, "_row")).alias("first")
    kept = named.groupBy("component_id").agg(first).select("first._row")
    return rows.join(kept, "_row", "left_semi").select(*own.columns).toDF(*docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of 50 words or more that also stand elsewhere."""
    return substring.without_repeats(docs, min_words=50)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with surrogates in place of personal data."""
    return pii.with_surrogates(docs, PII_KEY)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 4096 tokens."""
    return packing.packed(docs, TOKENIZER, length=4096, end=2)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("personal_data", personal_data),
    ("packing", packed),
]

#: Near-duplicate signatures, keyed surrogates and token ids are nothing that SQL can say.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``, each result written and read again as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
