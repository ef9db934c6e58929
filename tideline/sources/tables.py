"""Schemas and gated readers. Nothing is inferred: an absent column is an error, never a column of nulls."""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

KINDS = {"string": T.StringType(), "long": T.LongType(), "int": T.IntegerType(), "boolean": T.BooleanType(), "float": T.FloatType(), "double": T.DoubleType(), "binary": T.BinaryType(), "unsigned": T.DecimalType(20, 0)}


def fields(**columns: str) -> T.StructType:
    """A schema from the columns of each kind; unsigned 64-bit numbers are read as decimals."""
    return T.StructType([T.StructField(c, KINDS[k]) for k, names in columns.items() for c in names.split()])


MOVES = T.StructType([T.StructField("subtick_moves", T.ArrayType(fields(unsigned="button", boolean="pressed", float="when analog_forward_delta analog_left_delta pitch_delta yaw_delta")))])
COMMANDS = T.StructType(
    [
        *fields(
            string="demo_id", long="command_row_id demo_tick pawn_entity_handle", unsigned="steam_id buttonstate1 buttonstate2 buttonstate3", binary="command_protobuf", float="view_pitch view_yaw",
            int="round_id player_slot command_number client_tick server_tick_executed mousedx_raw mousedy_raw", boolean="alive is_warmup is_freeze_time base_present buttons_present viewangles_present",
        ),
        *MOVES,
    ]
)
STATES = fields(string="demo_id", long="demo_tick", unsigned="steam_id", int="round_id player_slot team health armor", boolean="alive is_warmup is_freeze_time is_paused", double="position_x position_y position_z", float="view_pitch view_yaw")
ROUNDS = fields(string="demo_id map", int="round_id round_number winner_team", long="start_tick freeze_end_tick end_tick", boolean="is_warmup")
EVENTS = fields(string="demo_id kind weapon", int="round_id player_slot", long="demo_tick", unsigned="steam_id")
LEDGER = fields(string="event sha256 payload", long="n frame_index thread qpc", int="movie", double="demo_tick")


class SchemaError(ValueError):
    pass


def require_columns(df: DataFrame, schema: T.StructType | list[str]) -> DataFrame:
    names = schema if isinstance(schema, list) else [f.name for f in schema]
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise SchemaError(f"missing columns: {', '.join(missing)}")
    return df


def require_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The same names and types, in any order."""
    require_columns(df, schema)
    wrong = [f.name for f in schema if df.schema[f.name].dataType != f.dataType]
    if wrong:
        raise SchemaError(f"types differ: {', '.join(wrong)}")
    return df


def read_table(spark: SparkSession, path: str, columns: list[str] | None = None, schema: T.StructType | None = None) -> DataFrame:
    """A Parquet table with the columns asked for; with a schema, exactly those types."""
    df = spark.read.parquet(path)
    if schema is not None:
        df = require_schema(df, schema).select([f.name for f in schema])
    return require_columns(df, columns).select(columns) if columns else df


def read_bounded(spark: SparkSession, path: str, columns: list[str], most: int) -> DataFrame:
    """The same, if the table has at most `most` rows (counted in the footers)."""
    df = read_table(spark, path, columns)
    n = spark.read.parquet(path).count()
    if n > most:
        raise SchemaError(f"{n} rows; the bound is {most}")
    return df


def read_ledger(spark: SparkSession, path: str, schema: T.StructType = LEDGER, longest: int = 4 << 20) -> DataFrame:
    """A JSON-lines ledger; a line that is no object of this schema, or is too long, or lacks its event, stops the read."""
    lines = spark.read.text(path)
    event = F.col("row.event")
    parsed = lines.select("value", F.from_json("value", schema, {"mode": "FAILFAST"}).alias("row"))
    fine = F.assert_true((F.octet_length("value") <= longest) & is_object(F.col("value")) & event.isNotNull(), "a line is too long, is not one object, or has no event")
    return parsed.withColumn("_ok", fine).where("_ok IS NULL").select("row.*")


def strict_json(text: str) -> dict:
    """One JSON object without repeated keys or numbers that are not finite."""

    def pairs(items):
        out = dict(items)
        if len(out) != len(items):
            raise SchemaError("repeated key")
        return out

    def constant(name):
        raise SchemaError(f"not finite: {name}")

    value = json.loads(text.removeprefix("﻿"), object_pairs_hook=pairs, parse_constant=constant)
    if not isinstance(value, dict):
        raise SchemaError("not an object")
    return value


def once(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is computed once a row, however often f names it: Spark computes what stands in branches anew."""
    return F.transform(F.array(value), f)[0]


def without_mark(text: Column) -> Column:
    """The text without a byte order mark before it."""
    return F.regexp_replace(text, "^\\x{FEFF}", "")


def _within(text: Column) -> tuple[Column, Column]:
    """The text as the one entry of a list and of an object. Spark's parsers take no notice of what follows a value; what
    follows the text can't be right in both."""
    return F.concat(F.lit("["), text, F.lit("]")), F.concat(F.lit('{"_":'), text, F.lit("}"))


def is_object(text: Column) -> Column:
    """Whether a text is one JSON object and nothing else; keys may be repeated."""
    listed, held = _within(text)
    whole = (F.json_array_length(listed) == 1) & (F.size(F.json_object_keys(held)) == 1) & F.json_object_keys(text).isNotNull()
    return F.coalesce(whole, F.lit(False))


def json_object(text: Column, schema: str) -> Column:
    """The fields of a text that is one JSON object, behind a byte order mark or not; null for any other text."""
    plain = without_mark(text)
    return F.when(is_object(plain), F.from_json(plain, schema))


def strict_object(text: Column) -> Column:
    """A text that is one JSON object as a variant; null where a key is repeated at any depth, or a number isn't finite."""
    listed, held = map(F.try_parse_json, _within(without_mark(text)))
    value = F.try_variant_get(held, "$._", "variant")
    return once(value, lambda v: F.when(listed.isNotNull() & F.schema_of_variant(v).startswith("OBJECT"), v))


def read_frames(spark: SparkSession, path: str) -> DataFrame:
    """Frames from Parquet or JSON lines, by the name's end."""
    return spark.read.json(path) if path.endswith((".jsonl", ".json")) else spark.read.parquet(path)


def discover(spark: SparkSession, folder: str, pattern: str, most: int = 10_000) -> DataFrame:
    """path, length, modificationTime of the files below a folder, without reading them."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder).select("path", "length", "modificationTime")
    if files.limit(most + 1).count() > most:
        raise SchemaError(f"more than {most} files")
    return files.orderBy("path")


def file_digests(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """path, length, sha256 of each file; compare two of these to see whether anything changed between.

    A file is one row of binaryFile and must fit a task; one of over 2 GB (spark.sql.sources.binaryFile.maxLength) stops
    the read. For tables of any size there are the digest trees of operators/digests.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder)
    return files.select("path", "length", F.sha2("content", 256).alias("sha256"))


def verified(spark: SparkSession, folder: str, expected: dict[str, str]) -> None:
    """Stop unless each named file has the digest that its manifest states."""
    got = {r["path"].rsplit("/", 1)[-1]: r["sha256"] for r in file_digests(spark, folder).where(F.element_at(F.split("path", "/"), -1).isin(list(expected))).collect()}
    wrong = sorted(k for k, v in expected.items() if got.get(k) != v)
    if wrong:
        raise SchemaError(f"digests differ: {', '.join(wrong)}")


def ledger_view(ledger: DataFrame, context: list[str], lo: int, hi: int) -> DataFrame:
    """The context events, and the frames lo <= frame_index < hi counted from 0, in ledger order."""
    head = ledger.where(F.col("event").isin(context)).withColumn("view_index", F.lit(None).cast("long"))
    frames = ledger.where(~F.col("event").isin(context) & (F.col("frame_index") >= lo) & (F.col("frame_index") < hi)).withColumn("view_index", F.col("frame_index") - lo)
    return head.unionByName(frames).orderBy("n")


def merged_events(ledgers: list[DataFrame], kinds: list[str]) -> DataFrame:
    """The events of these kinds of all ledgers in one order; of one number, those of the earlier ledger come first."""
    some = [x.where(F.col("event").isin(kinds)).withColumn("ledger", F.lit(i)) for i, x in enumerate(ledgers)]
    return reduce(DataFrame.unionByName, some).orderBy("n", "ledger")


def write_clustered(rows: DataFrame, path: str, by: list[str], parts: int | None = None) -> None:
    """Rows in files of ranges of `by`, sorted, and a manifest of each file's rows and least and greatest values. A value
    with many rows fills several files, so no task writes more than its share."""
    spark = rows.sparkSession
    dealt = rows.repartitionByRange(parts, *by) if parts else rows.repartitionByRange(*by)
    dealt.sortWithinPartitions(*by).write.mode("errorifexists").option("compression", "zstd").parquet(f"{path}/rows")
    place = F.struct(*by)
    files = spark.read.parquet(f"{path}/rows").groupBy(F.col("_metadata.file_name").alias("file")).agg(F.count("*").alias("n"), F.min(place).alias("least"), F.max(place).alias("greatest"))
    files.coalesce(1).write.mode("errorifexists").parquet(f"{path}/manifest")


def clustered_files(spark: SparkSession, path: str, low: tuple, high: tuple) -> list[str]:
    """Names of the files that may hold places from `low` to `high`, which may be shorter than the places are."""
    manifest = spark.read.parquet(f"{path}/manifest")
    names = manifest.schema["least"].dataType.names
    prefix = lambda c, n: F.struct(*(F.col(f"{c}.{x}") for x in names[:n]))
    literal = lambda values: F.struct(*(F.lit(v).cast(manifest.schema["least"].dataType[x].dataType).alias(x) for x, v in zip(names, values, strict=False)))
    some = manifest.where((prefix("greatest", len(low)) >= literal(low)) & (prefix("least", len(high)) <= literal(high)))
    return sorted(r["file"] for r in some.select("file").collect())


def read_clustered(spark: SparkSession, path: str, low: tuple, high: tuple, schema: T.StructType | str) -> DataFrame:
    """The rows from `low` to `high` of what write_clustered() wrote; files that can't hold any aren't opened."""
    manifest = spark.read.parquet(f"{path}/manifest")
    names, kinds = manifest.schema["least"].dataType.names, manifest.schema["least"].dataType
    files = clustered_files(spark, path, low, high)
    if not files:
        return spark.createDataFrame([], schema)
    literal = lambda values: F.struct(*(F.lit(v).cast(kinds[x].dataType).alias(x) for x, v in zip(names, values, strict=False)))
    rows = spark.read.schema(schema).parquet(*(f"{path}/rows/{f}" for f in files))
    #: The first column by itself reaches the scan; the rest of the place is compared with it as a whole.
    rows = rows.where(F.col(names[0]).between(F.lit(low[0]), F.lit(high[0])))
    return rows.where((F.struct(*names[: len(low)]) >= literal(low)) & (F.struct(*names[: len(high)]) <= literal(high)))
