"""A corpus pipeline of five stages over `documents`; each stage works on all that the one before it kept.

Every stage takes any columns beside those of `documents`, whatever they are called, and the first four return the
columns that they were given, with the values that they were given. An empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tideline.llm.decontaminate import decontaminate
from tideline.llm.minhash import near_duplicates
from tideline.llm.mixing import mix_sources
from tideline.llm.queries import TOXIC_AT, table, tokenizer_path
from tideline.llm.shared import forget, new_path, row_name, scratch, stored, without
from tideline.llm.token_codec import write_and_read
from tideline.llm.toxicity import fit, score_toxicity, train_fold

#: Numbers of documents without a doc_id begin here; doc_ids are smaller.
NO_ID = 1 << 62
#: The columns of `documents`; further ones go through a stage under names that no operator uses.
KNOWN = ("doc_id", "text", "lang", "source", "n_chars")
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def renamed(stage: Stage) -> Stage:
    """The stage, to which columns beside those of `documents` are _extra0, _extra1, ... and which gives them back."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        plain = docs.toDF(*(c if c in KNOWN else f"_extra{i}" for i, c in enumerate(docs.columns)))
        out = stage(spark, plain, sf_dir)
        return out.toDF(*docs.columns) if out.columns == plain.columns else out

    return run


@renamed
def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score under TOXIC_AT, by a model of the labels one may learn from.

    Each row is scored by its whole text: repeated rows go or stay together, and a null or empty text has the score of a
    text without known words, which stays under TOXIC_AT unless most labelled texts are toxic. Nulls elsewhere change
    nothing.
    """
    model = fit(docs, train_fold(table(spark, sf_dir, "labels")))
    return score_toxicity(docs, model, keep=tuple(docs.columns)).where(F.col("score") < TOXIC_AT).select(docs.columns)


@renamed
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest doc_id, and one row of it.

    A text without a doc_id goes by a number above NO_ID made of its bytes, so that a group keeps a document with an id
    where it has one; texts without words (null, empty, blank) stay, with or without one. Of rows that repeat a doc_id the
    first in the order of the other columns stays, whatever their texts. Very long texts are compared whole.
    """
    number = F.lit(NO_ID).bitwiseOR(F.shiftrightunsigned(F.xxhash64("text"), 2))
    worded = F.coalesce(F.col("text").rlike("[^ \\t-\\r]"), F.lit(False))
    named = docs.withColumns({"_none": F.col("doc_id").isNull(), "doc_id": F.when(F.col("doc_id").isNull() & worded, number).otherwise(F.col("doc_id").cast("long"))})
    back = F.when(~F.col("_none"), F.col("doc_id")).cast(docs.schema["doc_id"].dataType)
    return _one_of_each(named).withColumn("doc_id", back).select(docs.columns)


def _one_of_each(docs: DataFrame) -> DataFrame:
    """near_dedup(), of documents by their doc_id."""
    gone = near_duplicates(docs, shingle_words=5, percent=80).where("not kept").select("doc_id")
    left = without(docs, gone, "doc_id")
    twice = stored(left.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id"), "twice")
    if twice.isEmpty():
        return left.select(docs.columns)
    first = F.row_number().over(Window.partitionBy("doc_id").orderBy(*(c for c in docs.columns if c != "doc_id")))
    repeated = left.join(twice, "doc_id").withColumn("_row", first).where("_row = 1")
    return without(left, twice, "doc_id").select(docs.columns).unionByName(repeated.select(docs.columns))


@renamed
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window of words with a benchmark item.

    A null or empty text shares none; repeated rows go or stay together; an empty benchmark removes nothing. A null doc_id
    is no matter: rows are named by doc_id and text.
    """
    hit = decontaminate(docs, table(spark, sf_dir, "benchmark")).where("contaminated").select("k1", "k2")
    return without(docs.select("*", *row_name()), hit, ["k1", "k2"]).select(docs.columns)


@renamed
def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target weight asks, in a global random order.

    A null source is a source of its own; repeated rows, and all rows without a doc_id, draw alike; texts, null, empty or
    long, are not looked at.
    """
    return mix_sources(docs).select(docs.columns)


@renamed
def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document, read back from the coded files.

    A null or empty text has its end id alone. Rows that repeat a doc_id stand side by side in the order of their texts,
    rows without a doc_id first.
    """
    return write_and_read(docs, tokenizer_path(), new_path(spark, "ids"), added=True).drop("ids")


STAGES = [("toxicity", toxicity), ("near_dedup", near_dedup), ("decontamination", decontamination), ("mixing", mixing), ("tokens", tokens)]

#: SQL can express neither the fitted classifier nor the tokenizer; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages' result over `documents` of sf_dir: a row for each document that is left, as often as it is mixed in.

    Each stage's output is written to the shared folder and read back; what the stage wrote on the way, and its input, is
    deleted then. Only the last stage's tables stay, as its rows are read from them.
    """
    docs, read = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        with scratch(spark) as made:
            docs = stored(stage(spark, docs, sf_dir), name)
            made.pop()
        if read is not None:
            forget(read)
        read = docs
    return STAGES[-1][1](spark, docs, sf_dir)


def queries() -> dict:
    return {"pipeline": run}
