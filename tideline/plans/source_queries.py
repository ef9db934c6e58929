"""Queries of the readers, the sinks and the streams: each goes through files of the shared folder and comes back."""

from contextlib import contextmanager

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.operators import audits, scans
from tideline.plans.registry import query
from tideline.plans.views import CMD, FRAMES, STATE, commands, commands_of, frames, states
from tideline.sources import sinks, tables
from tideline.sources.scratch import new_folder
from tideline.streaming import stateful

C = F.col


@query("SELECT event_id, user_id FROM events")
def src_1_pruned_scan(spark, d):
    return tables.read_table(spark, f"{d}/events.parquet", ["event_id", "user_id"])


@query("SELECT r_regionkey, r_name FROM region")
def src_2_bounded_scan(spark, d):
    return tables.read_bounded(spark, f"{d}/region.parquet", ["r_regionkey", "r_name"], 1000)


@query("SELECT event_id, ts, user_id FROM events WHERE user_id = 42 AND event_type = 'view'")
def src_3_filtered_scan(spark, d):
    return tables.read_table(spark, f"{d}/events.parquet", ["event_id", "ts", "user_id", "event_type"]).where("user_id = 42 and event_type = 'view'").drop("event_type")


TYPED = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType())])


@query("SELECT event_id, user_id, event_type, round(value, 6) AS value FROM events")
def src_4_typed_reader(spark, d):
    return tables.read_table(spark, f"{d}/events.parquet", schema=TYPED).withColumn("value", F.round("value", 6))


def ledger(spark, d) -> DataFrame:
    """Commands as the rows of a ledger: its kind is the event, its order the row number."""
    return commands(spark, d).select(C("kind").alias("event"), C("row_id").alias("n"), C("tick").alias("frame_index"), C("cents").alias("qpc"), C("tick").cast("double").alias("demo_tick"))


OBJECTS = """txt AS (SELECT row_id, ltrim(CASE k % 4 WHEN 0 THEN p WHEN 1 THEN chr(65279) || p WHEN 2 THEN '[' || p || ']' ELSE p || '}' END, chr(65279)) AS t
  FROM (SELECT row_id, k, '{"k":' || k || ',"k":' || cents || '}' AS p FROM cmd))"""


@query("SELECT row_id, CASE WHEN NOT json_valid(t) THEN NULL WHEN json_type(t) = 'OBJECT' THEN true END AS is_object FROM txt", CMD, OBJECTS)
def src_5_json_objects(spark, d):
    """Texts that are one JSON object, some behind a byte order mark; lists and texts that go on are none."""
    p = F.concat(F.lit('{"k":'), "k", F.lit(',"k":'), "cents", F.lit("}"))
    mark = C("k") % 4
    text = F.when(mark == 0, p).when(mark == 1, F.concat(F.lit("\ufeff"), p)).when(mark == 2, F.concat(F.lit("["), p, F.lit("]"))).otherwise(F.concat(p, F.lit("}")))
    got = tables.json_object(C("t"), "k long")
    return commands(spark, d).select("row_id", text.alias("t")).select("row_id", F.when(got["k"].isNotNull(), True).alias("is_object"))


STRICT = """txt AS (SELECT row_id, CASE k % 5 WHEN 0 THEN '{"k":' || k || '}' WHEN 1 THEN '{"k":1,"k":' || k || '}' WHEN 2 THEN '{"k":2,"a":{"b":1,"b":' || k || '}}'
  WHEN 3 THEN '{"k":NaN}' ELSE '{"k":4,"a":{"b":' || k || '}}' END AS t FROM cmd)"""


@query(
    """SELECT row_id, CASE WHEN t LIKE '%NaN%' THEN NULL WHEN len(json_keys(t)) = len(list_distinct(json_keys(t))) AND (json_type(t, '$.a') IS NULL OR len(json_keys(t, '$.a')) = len(list_distinct(json_keys(t, '$.a'))))
      THEN CAST(t->>'k' AS BIGINT) END AS k FROM txt""",
    CMD,
    STRICT,
)
def src_6_strict_objects(spark, d):
    """Repeated keys, in the object or within it, and numbers that aren't finite are refused."""
    kind = C("k") % 5
    text = (
        F.when(kind == 0, F.concat(F.lit('{"k":'), "k", F.lit("}")))
        .when(kind == 1, F.concat(F.lit('{"k":1,"k":'), "k", F.lit("}")))
        .when(kind == 2, F.concat(F.lit('{"k":2,"a":{"b":1,"b":'), "k", F.lit("}}")))
        .when(kind == 3, F.lit('{"k":NaN}'))
        .otherwise(F.concat(F.lit('{"k":4,"a":{"b":'), "k", F.lit("}}")))
    )
    return commands(spark, d).select("row_id", text.alias("t")).select("row_id", F.try_variant_get(tables.strict_object(C("t")), "$.k", "long").alias("k"))


@query("SELECT kind AS event, row_id AS n, tick AS frame_index, cents AS qpc FROM cmd", CMD)
def src_7_ledger(spark, d):
    path = new_folder(spark)
    sinks.json_lines(ledger(spark, d), path)
    return tables.read_ledger(spark, path).select("event", "n", "frame_index", "qpc")


@query("SELECT kind AS event, count(*) AS n, 'refused' AS one_byte_less FROM cmd GROUP BY kind", CMD)
def src_8_bounded_ledger(spark, d):
    """A ledger read under the bound that its longest line just keeps; under a bound one byte less the read stops."""
    path = new_folder(spark)
    sinks.json_lines(ledger(spark, d), path)
    longest = spark.read.text(path).agg(F.max(F.octet_length("value"))).first()[0] or 1
    try:
        tables.read_ledger(spark, path, longest=longest - 1).agg(F.max("n")).collect()
        less = "read"
    except PySparkException as e:
        less = "refused" if "a line is too long" in str(e) else str(e)
    counts = tables.read_ledger(spark, path, longest=longest).groupBy("event").agg(F.count("*").alias("n"))
    return counts.withColumn("one_byte_less", F.lit(less))


@query("SELECT frame_index, start, \"end\", 2::BIGINT AS n FROM fr", CMD, FRAMES)
def src_9_frames_by_suffix(spark, d):
    path = new_folder(spark)
    frames(spark, d).write.parquet(f"{path}.parquet")
    frames(spark, d).write.json(f"{path}.jsonl")
    both = tables.read_frames(spark, f"{path}.parquet").unionByName(tables.read_frames(spark, f"{path}.jsonl"))
    return both.groupBy("frame_index", "start", "end").agg(F.count("*").alias("n"))


@query("SELECT n_nationkey, n_name, true AS complete FROM nation")
def src_10_gated_source(spark, d):
    """A published folder is complete once its report is there, and not before."""
    path = new_folder(spark)
    nation = spark.read.parquet(f"{d}/nation.parquet").select("n_nationkey", "n_name")
    before = sinks.is_complete(spark, path)
    sinks.publish({"nation": nation}, path, {"tables": ["nation"]})
    after = sinks.is_complete(spark, path)
    return tables.read_table(spark, f"{path}/nation", ["n_nationkey", "n_name"]).withColumn("complete", F.lit(after and not before))


@query("SELECT kind AS event, row_id AS n, tick AS frame_index, CASE WHEN kind <> 'signup' THEN tick - 2000 END AS view_index FROM cmd WHERE kind = 'signup' OR (tick >= 2000 AND tick < 9000)", CMD)
def src_19_ledger_view(spark, d):
    return tables.ledger_view(ledger(spark, d), ["signup"], 2000, 9000).select("event", "n", "frame_index", "view_index")


@query(
    """SELECT event, n, ledger, row_number() OVER (PARTITION BY n // 1440 ORDER BY n, ledger, event) AS place FROM (
      SELECT kind AS event, tick AS n, 0 AS ledger FROM cmd WHERE kind IN ('click', 'purchase') UNION ALL SELECT 'state', tick, 1 FROM st)""",
    STATE,
)
def src_20_merged_events(spark, d):
    """Two kinds of commands and the states in one order; each day's events, those of all recordings, are numbered in it."""
    first = commands(spark, d).select(C("kind").alias("event"), C("tick").alias("n"))
    second = states(spark, d).select(F.lit("state").alias("event"), C("tick").alias("n"))
    order = ["n", "ledger", "event"]
    merged = tables.merged_events([first, second], ["click", "purchase", "state"]).withColumn("day", F.floor(C("n") / 1440))
    return scans.scan(scans.ranged(merged, ["day"], order), ["day"], order, place=scans.running_count()).select("event", "n", "ledger", "place")


@query("SELECT unnest(['region', 'nation', 'customer', 'supplier', 'part', 'orders', 'lineitem', 'events']) || '.parquet' AS name, true AS some")
def src_21_discovered(spark, d):
    found = tables.discover(spark, d, "{region,nation,customer,supplier,part,orders,lineitem,events}.parquet")
    return found.select(F.element_at(F.split("path", "/"), -1).alias("name"), (C("length") > 0).alias("some"))


@query("SELECT slot, tick, x FROM st WHERE x % 2 = 0", STATE)
def snk_1_published(spark, d):
    path = new_folder(spark)
    sinks.publish({"states": states(spark, d).select("slot", "tick", "x", "moving")}, path, {"rows": "states"})
    return tables.read_table(spark, f"{path}/states").where("moving").drop("moving")


@query("SELECT 'refused' AS second, 25::BIGINT AS n")
def snk_2_no_overwrite(spark, d):
    """A second publication under one name is refused, and the first stays whole."""
    path = new_folder(spark)
    nation = spark.read.parquet(f"{d}/nation.parquet")
    sinks.publish({"nation": nation}, path, {})
    try:
        sinks.publish({"nation": nation.limit(1)}, path, {})
        second = "written"
    except FileExistsError:
        second = "refused"
    return spark.read.parquet(f"{path}/nation").agg(F.lit(second).alias("second"), F.count("*").alias("n"))


@query("SELECT count(*) AS n, CAST(sum(tick) AS BIGINT) AS ticks, 'refused' AS again, 'refused' AS not_finite FROM st", STATE)
def snk_4_json_rows(spark, d):
    """Rows as JSON and back; a second write to the path and one with a number that isn't finite are refused."""

    def tried(rows: DataFrame, to: str) -> str:
        try:
            sinks.json_lines(rows, to)
        except PySparkException as e:
            return "refused" if "already exists" in str(e) or "is not finite" in str(e) else str(e)
        return "written"

    rows, path = states(spark, d).select("slot", "tick", "yaw"), new_folder(spark)
    sinks.json_lines(rows, path)
    again = tried(rows, path)
    not_finite = tried(spark.range(1).select(F.lit(float("nan")).alias("yaw")), new_folder(spark))
    got = spark.read.schema("slot int, tick long, yaw double").json(path)
    return got.agg(F.count("*").alias("n"), F.sum("tick").alias("ticks"), F.lit(again).alias("again"), F.lit(not_finite).alias("not_finite"))


@query("SELECT n_nationkey, n_name, 'recording-1' AS demo_id, true AS zstd FROM nation")
def snk_5_identified_files(spark, d):
    """Zstandard Parquet files that carry the identity of their recording."""
    path = new_folder(spark)
    sinks.publish({"nation": sinks.identified(spark.read.parquet(f"{d}/nation.parquet").select("n_nationkey", "n_name"), {"demo_id": "recording-1"})}, path, {})
    got = spark.read.parquet(f"{path}/nation")
    kept = {f.metadata.get("demo_id") for f in got.schema}
    files = tables.discover(spark, f"{path}/nation", "*.parquet").agg(F.min(C("path").endswith(".zstd.parquet"))).first()[0]
    return got.withColumns({"demo_id": F.lit(",".join(sorted(kept))), "zstd": F.lit(files)})


@query("SELECT sha256(string_agg(n_name || chr(10), '' ORDER BY n_nationkey)) AS sha256, CAST(sum(length(n_name) + 1) AS BIGINT) AS length FROM nation")
def fn_h1_file_digest(spark, d):
    path = new_folder(spark)
    spark.read.parquet(f"{d}/nation.parquet").repartition(1).sortWithinPartitions("n_nationkey").select("n_name").write.text(path)
    return tables.file_digests(spark, path, "part-*").select("sha256", "length")


@query("SELECT alive AS accepted, count(*) AS n FROM cmd GROUP BY alive", CMD)
def snk_6_split_sink(spark, d):
    path = new_folder(spark)
    sinks.partitioned_by_verdict(commands(spark, d).select("row_id", "alive"), path, C("alive"))
    return spark.read.parquet(path).groupBy(C("accepted").cast("boolean").alias("accepted")).agg(F.count("*").alias("n"))


@query("SELECT count(*) AS n, CAST(sum(x) AS BIGINT) AS total, true AS bounded FROM st", STATE)
def snk_8_tensor_batches(spark, d):
    batches = sinks.tensor_batches(states(spark, d), ["x"], 32, "tick")
    sums = batches.select(F.size("x").alias("n"), F.aggregate("x", F.lit(0).cast("long"), lambda a, v: a + v).alias("total"))
    return sums.agg(F.sum("n").cast("long").alias("n"), F.sum("total").alias("total"), (F.max("n") <= 32).alias("bounded"))


@query("SELECT count(*) <= 1000 AS bounded FROM nation")
def aud_7_cardinality(spark, d):
    return spark.range(1).select(F.lit(audits.at_most(spark.read.parquet(f"{d}/nation.parquet"), 1000)).alias("bounded"))


@query("SELECT unnest(['nation.parquet', 'region.parquet']) AS name, true AS unchanged")
def aud_9_unchanged_files(spark, d):
    """Digests of files before and after their tables are read: the same."""
    first = tables.file_digests(spark, d, "{region,nation}.parquet").select("path", C("sha256").alias("before")).collect()
    spark.read.parquet(f"{d}/nation.parquet").count()
    known = spark.createDataFrame([tuple(r) for r in first], "path string, before string")
    after = tables.file_digests(spark, d, "{region,nation}.parquet").join(known, "path", "left")
    return after.select(F.element_at(F.split("path", "/"), -1).alias("name"), C("sha256").eqNullSafe(C("before")).alias("unchanged"))


@contextmanager
def rocks(spark: SparkSession):
    """The RocksDB state store, which doesn't count its rows at each change, and of which a batch writes the changes and no
    whole snapshot, as long as this lasts."""
    name = "spark.sql.streaming.stateStore."
    own = {f"{name}providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider", f"{name}rocksdb.trackTotalNumberOfRows": "false", f"{name}rocksdb.changelogCheckpointing.enabled": "true"}
    before = {k: spark.conf.get(k, None) for k in own}
    try:
        for k, v in own.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v else spark.conf.unset(k)


EVENTS = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"


def stream_of(spark, d) -> DataFrame:
    return spark.readStream.schema(EVENTS).option("pathGlobFilter", "events.parquet").parquet(d)


def drained(spark: SparkSession, rows: DataFrame, mode: str, path: str | None = None) -> DataFrame:
    """What a stream has put out once all that is there has been read; the last batch of a complete output. A path that
    was used before goes on from its state."""
    path = path or new_folder(spark)

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{'out' if mode == 'complete' else f'out/batch={number}'}")

    rows.writeStream.outputMode(mode).option("checkpointLocation", f"{path}/state").trigger(availableNow=True).foreachBatch(write).start().awaitTermination()
    return spark.read.parquet(f"{path}/out").select(rows.columns)


@query("SELECT user_id, start, \"end\", n FROM (SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 2 HOUR AS \"end\", count(*) AS n FROM (SELECT *, sum(s) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS g FROM (SELECT *, CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL 2 HOUR THEN 0 ELSE 1 END AS s FROM events)) GROUP BY user_id, g)")
def str_3_sessions(spark, d):
    return drained(spark, stateful.stream_sessions(stream_of(spark, d), "user_id", "ts", "2 hours"), "complete")


@query("SELECT user_id, time_bucket(INTERVAL 6 HOUR, ts) AS start, time_bucket(INTERVAL 6 HOUR, ts) + INTERVAL 6 HOUR AS \"end\", count(*) AS n FROM events GROUP BY 1, 2, 3")
def str_4_chunks(spark, d):
    return drained(spark, stateful.stream_chunks(stream_of(spark, d), "user_id", "ts", "6 hours"), "complete")


@query("SELECT DISTINCT user_id, event_type FROM events")
def str_6_first_of_key(spark, d):
    return drained(spark, stateful.stream_first_of_key(stream_of(spark, d), ["user_id", "event_type"], "ts", "60 days").select("user_id", "event_type"), "append")


@query("SELECT slot, row_id, CASE WHEN p IS NULL THEN 'first_command' WHEN tick - p NOT BETWEEN 0 AND 16 THEN 'demo_tick_discontinuity' WHEN number <> pn + 1 THEN 'command_number_discontinuity' END AS reset_reason FROM (SELECT slot, row_id, tick, number, lag(tick) OVER w AS p, lag(number) OVER w AS pn FROM cmd WINDOW w AS (PARTITION BY slot ORDER BY row_id))", CMD)
def str_1_stream_transitions(spark, d):
    """One pass over the commands with a small state for each slot, kept by the RocksDB store."""
    with rocks(spark):
        return drained(spark, stateful.stream_transitions(commands_of(stream_of(spark, d))), "append")


@query("SELECT slot, row_id, coalesce(NOT alive AND row_id < last, false) AS refused FROM (SELECT slot, row_id, alive, max(row_id) FILTER (WHERE alive) OVER (PARTITION BY slot) AS last FROM cmd)", CMD)
def str_2_out_of_order(spark, d):
    """Dead commands come after all live ones of their slot have been read: those of smaller numbers are errors."""
    path = new_folder(spark)
    events = spark.read.schema(EVENTS).parquet(f"{d}/events.parquet")
    with rocks(spark):
        for part in (events.where("event_type != 'error'"), events.where("event_type = 'error'")):
            part.write.mode("append").parquet(f"{path}/in")
            rows = commands_of(spark.readStream.schema(EVENTS).parquet(f"{path}/in"))
            out = drained(spark, stateful.stream_transitions(rows), "append", path)
    return out.select("slot", "row_id", C("reset_reason").eqNullSafe("out_of_order").alias("refused"))


@query("SELECT row_id, slot FROM cmd WHERE alive", CMD)
def str_10_resumable(spark, d):
    """Accepted rows appended batch by batch; a second run from the same checkpoint adds nothing."""
    path = new_folder(spark)
    for _ in range(2):
        rows = commands_of(stream_of(spark, d)).where("alive").select("row_id", "slot")
        stateful.resumable(rows, f"{path}/state", f"{path}/out").trigger(availableNow=True).start().awaitTermination()
    return sinks.CommitLog(spark, f"{path}/out").read(rows.schema)
