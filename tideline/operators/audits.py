"""Constraint checks: each gives the rows, or the one count, that violates it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def not_rising(df: DataFrame, keys: list[str], order: str, value: str, strict: bool = True) -> DataFrame:
    """Per key, how often value does not rise (or, not strictly, falls) in the order given."""
    w = Window.partitionBy(*keys).orderBy(order)
    bad = F.col(value) <= F.col("_p") if strict else F.col(value) < F.col("_p")
    return df.withColumn("_p", F.lag(value).over(w)).groupBy(*keys).agg(F.sum(F.when(bad, 1).otherwise(0)).cast("long").alias("violations"))


def contiguous_index(df: DataFrame, keys: list[str], index: str) -> DataFrame:
    """Per key, whether index is 0 to n - 1, each once."""
    return df.groupBy(*keys).agg(F.count("*").alias("n"), ((F.min(index) == 0) & (F.max(index) == F.count("*") - 1) & (F.countDistinct(index) == F.count("*"))).alias("contiguous"))


def sequence_gaps(df: DataFrame, keys: list[str], order: str, number: str) -> DataFrame:
    """Rows whose number is not one more than the number before it in their key."""
    w = Window.partitionBy(*keys).orderBy(order)
    return df.withColumn("previous", F.lag(number).over(w)).where(F.col("previous").isNotNull() & (F.col(number) != F.col("previous") + 1))


def different_from(df: DataFrame, column: str, value) -> DataFrame:
    return df.where(~F.col(column).eqNullSafe(F.lit(value)))


def at_most(df: DataFrame, n: int) -> bool:
    """Whether df has at most n rows; reads no more than n + 1."""
    return df.limit(n + 1).count() <= n


def differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows, counted, that only one of two tables has."""
    return left.exceptAll(right).withColumn("side", F.lit("left")).unionByName(right.exceptAll(left).withColumn("side", F.lit("right")))


def checks(df: DataFrame, keys: list[str], rules: dict[str, Column]) -> DataFrame:
    """One row for each key and rule: rows, failed, and the verdict; an unknown outcome neither passes nor fails."""
    from tideline.functions.bits import verdict

    each = F.explode(F.array(*(F.struct(F.lit(k).alias("check"), c.alias("ok")) for k, c in rules.items())))
    out = df.select(*keys, each.alias("x")).groupBy(*keys, F.col("x.check").alias("check")).agg(F.count("*").alias("n"), F.sum(F.when(F.col("x.ok"), 1).otherwise(0)).cast("long").alias("passed"), F.sum(F.when(~F.col("x.ok"), 1).otherwise(0)).cast("long").alias("failed"))
    return out.withColumn("status", verdict(F.col("n"), F.col("failed"), F.col("passed")))


def schema_issues(text: Column, kinds: dict[str, str]) -> Column:
    """What keeps a JSON object from its schema, as an array: missing:, kind: and unknown: fields, in this order of fields.
    kinds: of each field its kinds as Spark names those of a variant, '|' between; VOID allows a null. A text that is no
    JSON object (or repeats a key) has the one issue `object`."""
    from tideline.sources.tables import once, strict_object

    def issues(x: Column) -> Column:
        value, found, out = x["value"], x["found"], []
        for name, kind in kinds.items():
            own = F.schema_of_variant(F.try_variant_get(value, f"$.{name}", "variant"))
            wrong = F.when(~own.rlike(f"^(?:{kind})"), F.lit(f"kind:{name}"))
            out.append(F.when(~F.array_contains(found, name), F.lit(f"missing:{name}")).otherwise(wrong))
        unknown = F.transform(F.array_except(found, F.array(*map(F.lit, kinds))), lambda k: F.concat(F.lit("unknown:"), k))
        return F.when(value.isNull(), F.array(F.lit("object"))).otherwise(F.concat(F.array_compact(F.array(*out)), unknown))

    return once(F.struct(strict_object(text).alias("value"), F.json_object_keys(text).alias("found")), issues)
