"""The queries of the training-data operators: each applies one operator to its whole table and derives its digests."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm import sql
from tideline.llm.archives import archive_pages
from tideline.llm.chat_format import format_preferences
from tideline.llm.conversation_repair import damaged, repair_conversations
from tideline.llm.curves import nearest
from tideline.llm.decontaminate import decontaminate
from tideline.llm.license_scan import scan_licenses
from tideline.llm.minhash import near_duplicates
from tideline.llm.mixing import mix_sources
from tideline.llm.secrets import find_secrets
from tideline.llm.shared import new_path
from tideline.llm.substring_dedup import dedup_substrings
from tideline.llm.token_codec import write_and_read
from tideline.llm.toxicity import fit, score_toxicity, train_fold
from tideline.llm.whitening import whiten

TOXIC_AT = 0.7


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each conversation against itself with its last assistant turn answered as conv_id xor 1 answers last.

    A row for each conv_id: where conv_id xor 1 has no answer, the rejected answer is empty; where the conversation itself
    has none, both sides are all prompt. Turns with a null conv_id have no row. All turns of a conversation are rendered,
    null ones first.
    """
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    last = turns.where("role = 'assistant' and conv_id is not null").groupBy("conv_id").agg(F.max(F.struct("turn", "text")).alias("last"))
    other = last.select(F.col("conv_id").bitwiseXOR(F.lit(1)).alias("conv_id"), F.col("last.text").alias("other"))
    pairs = last.select("conv_id", F.col("last.turn").alias("last_turn")).join(other, "conv_id", "left")
    rows = turns.join(pairs, "conv_id", "left").withColumnRenamed("conv_id", "pair_id")
    replaced = (F.col("turn") == F.col("last_turn")) & (F.col("role") == "assistant")
    rejected = rows.withColumn("text", F.when(replaced, F.coalesce("other", F.lit(""))).otherwise(F.col("text")))
    out = format_preferences(rows, rejected)
    said = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws(":", x["start"], x["end"])), ",")
    return out.withColumns({"chosen_mask": said("chosen_mask"), "rejected_mask": said("rejected_mask")})


def op2_curves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows found of each row of `embeddings` whose vec_id 20 divides; see curves.nearest for what takes no part."""
    return nearest(table(spark, sf_dir, "embeddings"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of `documents`, mixed by the square roots of their sources' sizes; see mixing.mix_sources for nulls and repeats."""
    return mix_sources(table(spark, sf_dir, "documents")).withColumn("rate", F.round("rate", 9))


def op4_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the token files of all `documents` say of each, with the end id; a null or empty text has that id alone."""
    return write_and_read(table(spark, sf_dir, "documents"), tokenizer_path(), new_path(spark, "ids"), added=True).drop("ids")


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each of all `documents`, how many repeated passages of 20 take away, and a digest of what stays."""
    out = dedup_substrings(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingles, component and `kept` of each of all `documents`, at 3 words and a similarity of 0.85."""
    return near_duplicates(table(spark, sf_dir, "documents"), shingle_words=3, percent=85, slots=40)


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licences that whole texts of `documents` hold, as license_scan.scan_licenses gives them."""
    return scan_licenses(table(spark, sf_dir, "documents"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, digest and spans of the secrets of each of all `documents`; linked weak candidates are among `spans` only."""
    out = find_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda x: ~x["linked"])
    said = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    n = lambda kind: F.size(F.filter(base, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return out.select("doc_id", n("assign"), n("access"), n("hex"), F.sha2(said(base).cast("binary"), 256).alias("base_sha256"), said(F.col("spans")).alias("spans"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A score of each of all `documents`, by labels of ids whose crc32 modulo 3 is not 1; a null doc_id is not held out."""
    docs = table(spark, sf_dir, "documents")
    scored = score_toxicity(docs, fit(docs, train_fold(table(spark, sf_dir, "labels"))))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= TOXIC_AT).cast("int").alias("predicted"))


def op10_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each of all `documents`, those hit by passages of `benchmark`, and a digest of the items."""
    out = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    items = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), items.alias("items_sha256"), "contaminated")


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the archives of all `pages` say of each: its payload's length and digest, and which page's payload it is."""
    return archive_pages(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of each of all `conversations`, damaged and repaired; one without rows left has zeros and no text."""
    turns = table(spark, sf_dir, "conversations")
    report, _ = repair_conversations(damaged(turns), texts=False)
    ids = turns.select(F.col("conv_id").cast("long").alias("_conv")).distinct()
    out = ids.join(report, F.col("_conv").eqNullSafe(F.col("conv_id")), "left")
    numbers = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    return out.select(F.col("_conv").alias("conv_id"), *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", nothing).alias("repaired_sha256"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first four components of each of all `embeddings`, whitened; see whitening.whiten for what takes no part."""
    out = whiten(table(spark, sf_dir, "embeddings"))
    return out.withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_chat_format, op2_curves, op3_mixing, op4_tokens, op5_substring_dedup, op6_minhash, op7_licenses, op8_secrets, op9_toxicity, op10_winnowing, op11_warc, op12_repair, op13_whitening)
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    return dict(sql.ORACLES)
