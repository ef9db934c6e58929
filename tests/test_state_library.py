"""Scans, streams with state, digests, commits, dyadic joins and bounded accumulators against plain versions."""

import random
import statistics
import threading
from collections import Counter, defaultdict

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tideline.operators import aggregates, buttons, cadence, digests, discovery, dispatch, integrity, joins, samples, scans, selection, windows
from tideline.plans.source_queries import drained, rocks
from tideline.sources import sinks, tables
from tideline.streaming import processors

C = F.col


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ---- scans


def hot_rows(spark, n=3000, seed=1):
    """One key with most of the rows, a null key, nulls in all values."""
    rng = random.Random(seed)
    rows = [(rng.choice(["hot"] * 8 + ["b", "c", None]), i, rng.choice([None, rng.randrange(100)]), rng.choice(["x", "y", None])) for i in range(n)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "key string, t long, v long, s string").repartition(4)


def test_scans_are_windows_over_whole_keys(spark):
    df, order = hot_rows(spark), ["t"]
    rows = scans.ranged(df, ["key"], order, parts=7)
    assert rows.where("key = 'hot'").select(scans.RANGE).distinct().count() >= 5
    out = scans.scan(rows, ["key"], order, n=scans.running_count(), total=scans.running_sum(C("v")), top=scans.running_max(C("v")), low=scans.running_min(C("v")), odd=scans.running_count(C("v") % 2 == 1))
    out = scans.last_known(scans.previous(out, ["key"], order, ["v", "s"]), ["key"], order, ["s"])
    out = scans.scanned_islands(out, ["key"], order, ["s"], lambda before: ~before("s").eqNullSafe(C("s")))
    w = Window.partitionBy("key").orderBy("t")
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    plain = df.select(
        "*",
        F.row_number().over(w).cast("long").alias("n"),
        F.sum("v").over(so_far).alias("total"),
        F.max("v").over(so_far).alias("top"),
        F.min("v").over(so_far).alias("low"),
        F.sum(F.when(C("v") % 2 == 1, 1).otherwise(0).cast("long")).over(so_far).alias("odd"),
        F.lag("v").over(w).alias("previous_v"),
        F.lag("s").over(w).alias("previous_s"),
        F.last("s", ignorenulls=True).over(so_far).alias("last_s"),
    )
    cut = plain.withColumn("cut", ((C("n") == 1) | ~C("previous_s").eqNullSafe(C("s"))).cast("long"))
    plain = cut.withColumn("island", F.sum("cut").over(so_far)).drop("cut")
    columns = plain.columns
    assert sorted(map(str, out.select(columns).collect())) == sorted(map(str, plain.collect()))


def test_scan_of_one_key_and_of_nothing(spark):
    df = hot_rows(spark, 500)
    out = scans.scan(scans.ranged(df, [], ["t"], parts=5), [], ["t"], n=scans.running_count())
    assert sorted(r["n"] for r in out.collect()) == list(range(1, 501))
    assert scans.scan(scans.ranged(df.where("false"), ["key"], ["t"]), ["key"], ["t"], n=scans.running_count()).count() == 0


# ---- streams


def slices(spark, df, order, cuts, path):
    """df as a stream of batches cut at the given places of its order."""
    rows = sorted(df.collect(), key=lambda r: tuple(r[c] for c in order))
    for a, b in zip([0, *cuts], [*cuts, len(rows)], strict=True):
        part = rows[a:b]
        random.Random(a).shuffle(part)
        spark.createDataFrame(part, df.schema).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def stream_rows(spark, n=400, seed=2):
    rng, t, rows = random.Random(seed), 0, []
    for i in range(n):
        t += rng.choice([1, 1, 1, 2, 9])
        rows.append((rng.randrange(3), t, i, rng.choice("abcdef"), rng.choice(["on", "on", "on", "off"]), rng.randrange(1000)))
    return spark.createDataFrame(rows, "key int, t long, id long, item string, mode string, v long")


CUTS = [[], [57, 58, 200]]


@pytest.mark.parametrize("cuts", CUTS)
@pytest.mark.parametrize("back", [4, 4096])
def test_streamed_repeats_are_those_of_the_batch(spark, tmp_path, cuts, back):
    df = stream_rows(spark)
    with rocks(spark):
        got = drained(spark, processors.stream_repeated_within(slices(spark, df, ["t", "id"], cuts, f"{tmp_path}/in"), "key", "t", "id", C("item"), back), "append", f"{tmp_path}/run")
    expected = windows.repeated_within(df, "key", ["item"], "id", back)
    assert {(r["id"], r["duplicate"]) for r in got.collect()} == {(r["id"], r["duplicate"]) for r in expected.collect()}


@pytest.mark.parametrize("cuts", CUTS)
def test_streamed_histories(spark, tmp_path, cuts):
    df, expected, held, last = stream_rows(spark), {}, defaultdict(list), {}
    for r in sorted(df.collect(), key=lambda r: (r["t"], r["id"])):
        before = last.get(r["key"])
        if before and (r["t"] - before["t"] > 8 or r["mode"] != before["mode"]):
            held[r["key"]] = []
        held[r["key"]].append(r["v"])
        last[r["key"]] = r
        if len(held[r["key"]]) >= 4:
            expected[r["id"]] = held[r["key"]][-4:]
    with rocks(spark):
        got = drained(spark, processors.stream_histories(slices(spark, df, ["t", "id"], cuts, f"{tmp_path}/in"), "key", "t", "id", C("mode"), "v", 4, 8), "append", f"{tmp_path}/run")
    assert {r["id"]: r["history"] for r in got.collect()} == expected


@pytest.mark.parametrize("cuts", CUTS)
def test_streamed_epochs(spark, tmp_path, cuts):
    df, expected, state = stream_rows(spark), {}, defaultdict(lambda: [0, None, None])
    for r in sorted(df.collect(), key=lambda r: (r["t"], r["id"])):
        s = state[r["key"]]
        if r["item"] == "a":
            s[0], s[1] = s[0] + 1, None
        if r["item"] != "b":
            s[1], s[2] = (max(x, r["v"]) if x is not None else r["v"] for x in s[1:])
        expected[r["id"]] = tuple(s)
    resets, ignored = C("item") == "a", C("item") == "b"
    with rocks(spark):
        got = drained(spark, processors.stream_epochs(slices(spark, df, ["t", "id"], cuts, f"{tmp_path}/in"), "key", "t", "id", resets, ignored, "v"), "append", f"{tmp_path}/run")
    assert {r["id"]: (r["epoch"], r["in_epoch"], r["lifetime"]) for r in got.collect()} == expected


def test_streamed_sessions_close_and_are_forgotten(spark, tmp_path):
    """Gaps and changes of state close sessions over batches in any order within the lateness; no state is left behind."""
    rng, t, rows = random.Random(6), 0, []
    for i in range(300):
        t += rng.choice([5, 5, 20, 200])
        rows.append((rng.randrange(4), t, i, rng.choice(["in", "in", "in", "out"])))
    expected = []
    for key in range(4):
        session = None
        for _, at, _, state in sorted(r for r in rows if r[0] == key):
            if session and at - session[2] <= 60 and state == session[3]:
                session[2], session[4] = at, session[4] + 1
            else:
                session = [key, at, at, state, 1]
                expected.append(session)
    swapped = list(rows)
    for i in range(0, 300, 10):
        swapped[i : i + 10] = rng.sample(swapped[i : i + 10], 10)
    for part in (swapped[:90], swapped[90:200], swapped[200:], [(99, t + 100_000, 1000, "end")]):
        df = spark.createDataFrame(part, "key int, s long, id long, state string").select("key", F.timestamp_seconds("s").alias("ts"), "id", "state")
        df.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    with rocks(spark):
        out = drained(spark, processors.stream_state_sessions(stream, "key", "ts", "id", C("state"), 60, "10 minutes"), "append", f"{tmp_path}/run")
        got = sorted((r["key"], r["start"], r["last"], r["state"], r["n"]) for r in out.select("key", F.unix_seconds("start").alias("start"), F.unix_seconds("last").alias("last"), "state", "n").collect())
        assert got == sorted(map(tuple, expected))
        for name, form in (("open", ["key"]), ("waiting", ["key"])):
            left = spark.read.format("statestore").option("stateVarName", name).load(f"{tmp_path}/run/state")
            assert {r["key"]["key"] for r in left.select(*form).collect()} <= {99}


# ---- digests


def test_digest_trees_find_what_differs(spark, tmp_path):
    rows = [(i - 500, i % 7, f"v{i}") for i in range(5000)] + [(None, 1, "none")]
    df, columns = spark.createDataFrame(rows, "id long, a int, b string"), ["a", "b"]
    digests.publish_with_digests(df, f"{tmp_path}/t", "id", columns, 10)
    same = digests.compare_with_published(spark, df.repartition(5), f"{tmp_path}/t", "id", columns, 10)
    assert same.rows.isEmpty() and same.opened == 0 and same.compared <= 4
    anew = df.where("id is null or id not in (40, -3)").withColumn("b", F.when(C("id") == 77, "edited").otherwise(C("b")))
    anew = anew.unionByName(df.where("id in (1234, 4000)")).unionByName(spark.createDataFrame([(9_000_000, 1, "new"), (None, 2, "also none")], df.schema))
    found = digests.compare_with_published(spark, anew, f"{tmp_path}/t", "id", columns, 10)
    assert {(r["id"], r["status"]) for r in found.rows.collect()} == {(40, "missing"), (-3, "missing"), (77, "changed"), (1234, "repeated"), (4000, "repeated"), (9_000_000, "added"), (None, "changed")}
    assert found.opened == 7 and found.leaves == 501
    empty = digests.compare_with_published(spark, df.where("false"), f"{tmp_path}/t", "id", columns, 10)
    assert empty.rows.count() == 5001


# ---- dyadic joins


def test_dyadic_joins_take_any_length(spark):
    rng = random.Random(12)
    spans = [(i, rng.randrange(3), s, s + rng.choice([0, 1, 2, 3, 100, 2 ** rng.randrange(41)])) for i in range(300) for s in [rng.randrange(-(2**20), 2**20)]] + [(900, 0, None, 5), (901, 0, 5, 4), (902, 1, -(2**40), 2**40)]
    points = [(i, rng.randrange(3), rng.randrange(-(2**21), 2**21)) for i in range(1500)] + [(5000, 1, None), (5001, 2, 2**39)]
    a = spark.createDataFrame(points, "id long, key int, t long").repartition(3)
    b = spark.createDataFrame(spans, "span long, key int, lo long, hi long")
    met = joins.dyadic_join(a, b, "t", "lo", "hi", ("key",))
    assert met.columns == ["id", "key", "t", "span", "lo", "hi"]
    got = Counter((r["id"], r["span"]) for r in met.collect())
    assert got == Counter((i, s) for i, k, t in points for s, own, lo, hi in spans if k == own and t is not None and lo is not None and lo <= t < hi)
    for r in b.where("lo < hi").select("lo", "hi", joins.dyadic_nodes(C("lo"), C("hi")).alias("nodes")).collect():
        covered = sorted((x["node"] << x["level"], (x["node"] + 1) << x["level"]) for x in r["nodes"])
        assert covered[0][0] == r["lo"] and covered[-1][1] == r["hi"] and all(x[1] == y[0] for x, y in zip(covered, covered[1:], strict=False))
        assert len(covered) <= 2 * max(1, (r["hi"] - r["lo"]).bit_length())
    assert joins.dyadic_join(a, b.where("false"), "t", "lo", "hi", ("key",)).count() == 0


def test_dyadic_joins_send_no_ranges_to_the_driver(spark, tmp_path):
    """Neither planned as a broadcast, by the size of the unexploded intervals, nor run as one."""
    spark.range(2000).select("id", (C("id") % 3).alias("key"), C("id").alias("t")).write.parquet(f"{tmp_path}/a")
    spark.range(500).select((C("id") % 3).alias("key"), (-C("id") * 1000).alias("lo"), (C("id") * 999).alias("hi")).write.parquet(f"{tmp_path}/b")
    met = joins.dyadic_join(spark.read.parquet(f"{tmp_path}/a"), spark.read.parquet(f"{tmp_path}/b"), "t", "lo", "hi", ("key",))
    plans = [met._jdf.queryExecution().executedPlan().toString()]
    assert met.count() == sum(k % 3 == t % 3 and -k * 1000 <= t < k * 999 for k in range(500) for t in range(2000))
    met.collect()
    plans.append(met._jdf.queryExecution().executedPlan().toString())
    assert not any("Broadcast" in p for p in plans)


# ---- bounded accumulators and turns


def test_reservoirs(spark):
    rng = random.Random(3)
    rows = [("big", i, rng.gauss(50, 10)) for i in range(6000)] + [("small", i, float(i)) for i in range(9)] + [("none", 1, None)]
    df = spark.createDataFrame(rows, "key string, id long, x double")
    first = {r["key"]: r for r in aggregates.sampled_median_and_mad(df.repartition(2), ["key"], "x", "id", 400).collect()}
    second = {r["key"]: r for r in aggregates.sampled_median_and_mad(df.repartition(9, "x"), ["key"], "x", "id", 400).collect()}
    assert first == second and set(first) == {"big", "small"}
    assert (first["small"]["n"], first["small"]["sampled"], first["small"]["median"], first["small"]["mad"]) == (9, 9, 4.0, 2.0)
    big = sorted(x for k, _, x in rows if k == "big")
    assert first["big"]["n"] == 6000 and first["big"]["sampled"] == 400
    share = sum(x <= first["big"]["median"] for x in big) / 6000
    assert abs(share - 0.5) < 2 / 400**0.5
    assert abs(first["big"]["mad"] - statistics.median(abs(x - statistics.median(big)) for x in big)) < 2
    plan = plan_of(aggregates.reservoir(df, ["key"], "x", "id", 400))
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")


def test_turns_are_limited_before_the_shuffle(spark):
    df = spark.range(3000).select(C("id").alias("row_id"), F.when(C("id") % 10 < 8, "hot").otherwise(C("id").cast("string")).alias("g"))
    few = selection.first_turns(df, ["g"], "row_id", 5)
    plan = plan_of(few)
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")
    every = selection.round_robin(df, ["g"], "row_id").where("turn <= 5")
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, every.collect()))
    picks = [(r["turn"], r["g"]) for r in selection.dealt_turns(df, ["g"], "row_id", 50).collect()]
    assert picks == sorted((r["turn"], r["g"]) for r in every.collect())[:50]


# ---- commits


def test_rival_and_dead_writers(spark, tmp_path):
    log, rows = sinks.CommitLog(spark, f"{tmp_path}/t"), spark.range(100)
    assert log.read("id long").count() == 0
    won = []
    threads = [threading.Thread(target=lambda i=i: won.append(log.append(rows.withColumn("by", F.lit(i)), "one"))) for i in range(3)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(won) == [False, False, True]
    rows.withColumn("by", F.lit(9)).write.parquet(f"{tmp_path}/t/data/two-dead")
    assert log.append(rows.withColumn("by", F.lit(5)), "two", {"rows": 100}) and not log.append(rows.withColumn("by", F.lit(6)), "two")
    read = log.read("id long, by int")
    assert read.count() == 200 and read.select("by").distinct().count() == 2 and not read.where("by in (9, 6)").count()
    assert log.entries()["two"]["report"] == {"rows": 100} and log.orphans() == ["data/two-dead"]


def test_rival_publishers(spark, tmp_path):
    done = []

    def run(i):
        try:
            sinks.publish({"rows": spark.range(50).withColumn("by", F.lit(i))}, f"{tmp_path}/p", {"by": i})
            done.append(i)
        except FileExistsError:
            pass

    threads = [threading.Thread(target=run, args=(i,)) for i in range(3)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    out = spark.read.parquet(f"{tmp_path}/p/rows")
    assert len(done) == 1 and out.count() == 50 and {r["by"] for r in out.select("by").distinct().collect()} == set(done)
    with pytest.raises(FileExistsError):
        sinks.publish({"rows": spark.range(1)}, f"{tmp_path}/p", {})


def test_streams_commit_batches(spark, tmp_path):
    from tideline.streaming import stateful

    for i in range(3):
        spark.range(10 * i, 10 * i + 10).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    for run in range(2):
        stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        stateful.resumable(stream, f"{tmp_path}/check{run}", f"{tmp_path}/out").trigger(availableNow=True).start().awaitTermination(60)
    log = sinks.CommitLog(spark, f"{tmp_path}/out")
    assert sorted(r["id"] for r in log.read("id long").collect()) == list(range(30)) and len(log.entries()) == 3


# ---- clustered ledgers


def test_clustered_ledgers_open_few_files(spark, tmp_path):
    rng = random.Random(4)
    rows = [(rng.choice(["hot"] * 9 + ["cold"]), rng.randrange(10_000), i) for i in range(8000)]
    df = spark.createDataFrame(rows, "event string, t long, n long").repartition(4)
    tables.write_clustered(df, f"{tmp_path}/l", ["event", "t", "n"], parts=16)
    manifest = spark.read.parquet(f"{tmp_path}/l/manifest").collect()
    assert sum(r["n"] for r in manifest) == 8000 and max(r["n"] for r in manifest) < 3 * 8000 / 16
    for low, high in ((("hot", 100), ("hot", 600)), (("cold",), ("cold",)), (("hot", 5000, 3), ("hot", 5000, 7)), (("none",), ("none",)), (("cold", 9000), ("hot", 50))):
        got = sorted(map(tuple, tables.read_clustered(spark, f"{tmp_path}/l", low, high, df.schema).collect()))
        assert got == sorted(r for r in rows if low <= r[: len(low)] and r[: len(high)] <= high)
    assert len(tables.clustered_files(spark, f"{tmp_path}/l", ("hot", 100), ("hot", 600))) <= 3 < len(manifest)


# ---- integrity and cadence


def test_integrity_tells_errors_from_warnings(spark):
    kinds = "slot int, row_id long, tick long, number long, yaw double, pitch double, p1 long, present boolean"
    fine = [(1, i, i, i, 0.0, 0.0, 1, True) for i in range(5)]
    c = lambda rows: spark.createDataFrame(rows, kinds)
    assert integrity.command_issues(c(fine)).isEmpty() and integrity.order_issues(c(fine)).isEmpty()
    bad = [(1, 0, 5, 1, None, 0.0, 1, None), (1, 1, 4, 3, None, 99.0, 1, True), (1, 2, 4, 3, None, 0.0, 300, True), (2, 9, 1, 1, 1.0, None, None, True)]
    got = {(r["scope"], r["code"]): (r["severity"], r["n"]) for r in integrity.command_issues(c(bad)).collect()}
    assert got == {
        ("slot:1", "number_gaps"): ("warning", 1),
        ("slot:1", "number_reversals"): ("warning", 1),
        ("slot:1", "tick_reversals"): ("warning", 1),
        ("slot:1", "repeated_commands"): ("warning", 1),
        ("slot:1", "numbers_out_of_range"): ("error", 2),
        ("slot:1", "all_view_angles_missing"): ("error", 3),
        ("slot:1", "some_buttons_missing"): ("warning", 1),
    }
    assert integrity.order_issues(c(bad)).first()["n"] == 1
    rounds = spark.createDataFrame([(1, 0, 5, 10), (1, 0, 5, 10), (2, 9, 5, None), (3, 9, 10, 8)], "round_id int, start long, freeze_end long, end long")
    assert {r["code"]: r["n"] for r in integrity.round_issues(rounds).collect()} == {"repeated_rounds": 1, "rounds_backwards": 2, "rounds_without_end": 1}
    assert [r["code"] for r in integrity.round_issues(rounds.where("false")).collect()] == ["no_rounds"]
    states = spark.createDataFrame([(1, 1, 7), (1, 2, 8), (1, 3, 8)], "slot int, tick long, user_id long")
    every = integrity.integrity(c(fine), states, rounds.where("round_id = 2 and false"), {"commands": 5, "states": 3, "eligible": 8, "rejected": 2})
    assert {(r["code"], r["n"]) for r in every.collect()} == {("identity_changes", 1), ("no_rounds", 1), ("unaccounted_payloads", 1)}
    assert not integrity.passes(every) and integrity.passes(every.where("code = 'identity_changes'"))


def test_cadence_and_startup(spark):
    times = [(1, i, t) for i, t in enumerate([0, 10, 20, 20, 15, 300, 310, None, 320])]
    rows = spark.createDataFrame(times, "slot int, row_id long, t long")
    steps = cadence.intervals(rows, ["slot"], "row_id", "t", 100)
    (s,) = cadence.summary(steps, ["slot"]).collect()
    assert (s["n"], s["invalid"], s["above"], s["least"], s["middle"], s["high"], s["most"]) == (8, 4, 1, 10, 10.0, 285, 285)
    marks = spark.createDataFrame([(1, 15, "b"), (1, 15, "a"), (1, 400, "end"), (2, 0, "other")], "slot int, at long, name string")
    acts = spark.createDataFrame([(1, t) for t in (0, 9, 10, 305, 306, 100)], "slot int, at long")
    most = cadence.nearby(cadence.around(cadence.largest(steps, ["slot"], "row_id", 1), marks, ["slot"], "at", "name"), acts, ["slot"], "at", 5, "row_id")
    (r,) = most.collect()
    assert (r["gap"], r["previous_milestone"], r["previous_at"], r["next_milestone"], r["next_at"], r["actions"]) == (285, "a", 15, "end", 400, 3)
    samples = spark.createDataFrame([(1, 1, 0, 5), (1, 2, 0, -1), (1, 3, 1, 0), (1, 4, 0, 200), (1, 5, 1, None)], "slot int, at long, stage int, gap long")
    got = {r["stage"]: tuple(r)[2:] for r in cadence.startup(samples, ["slot"], "at", C("stage"), C("gap"), 100).collect()}
    assert got == {0: (3, 2, 2, 1, 200, 4, 3), 1: (2, 1, 0, 0, 0, 3, 2)}


def test_samples_have_all_that_is_against_them(spark):
    rows = [(1, i, None if i == 5 else float(i), [True, True, None, False][i] if i < 4 else True) for i in range(12)] + [(2, 0, 1.0, True)]
    df = spark.createDataFrame(rows, "slot int, id long, yaw double, seen boolean")
    quality = F.array_compact(F.array(F.when(C("yaw").isNull(), F.lit("no_view"))))
    out = samples.accept_samples(df, ["slot"], ["id"], "id", quality, C("seen"), 3, 2)
    got = {(r["slot"], r["id"]): (r["reason_codes"], r["training_ready"], r["window_complete"], r["window_ids"]) for r in out.collect()}
    assert got[1, 0] == (["insufficient_history"], False, False, [0, 1, 2])
    assert got[1, 2] == (["proof_unknown"], False, True, [0, 1, 2, 3, 4])
    assert got[1, 3] == (["no_view", "proof_rejected"], False, True, [1, 2, 3, 4, 5])
    assert got[1, 7] == (["no_view"], False, True, [5, 6, 7, 8, 9]) and got[1, 8] == ([], True, True, [6, 7, 8, 9, 10])
    assert got[1, 11][0] == ["insufficient_future"] and got[2, 0][0] == ["insufficient_future", "insufficient_history"]
    assert out.select("sample_id").distinct().count() == 13
    report = {r["slot"]: tuple(r)[1:] for r in samples.acceptance_report(out, ["slot"]).collect()}
    assert report[2] == (1, 0, 0, 1, '{"insufficient_future":1,"insufficient_history":1}')
    assert report[1][:4] == (12, 8, 2, 10)


# ---- discovery


def plain_windows(states, length, max_gap):
    """[start, end) and falls of health, state by state."""
    out, run, prior = [], [], None
    for slot, tick, ok, who, health in sorted(states, key=lambda r: (r[0], r[1])):
        if run and (not ok or prior is None or prior[0] != slot or tick - prior[1] > max_gap or prior[2] != who):
            run = []
        if ok:
            run.append((tick, health))
        prior = (slot, tick, who)
        if len(run) == length:
            falls = sum(1 for (_, a), (_, b) in zip(run, run[1:], strict=False) if a is not None and b is not None and b < a)
            out.append((slot, who, run[0][0], run[-1][0] + 1, falls))
            run = []
    return out


def plain_hints(windows, commands, margin, allowed, sustained):
    """One command after another: held reload (16), passages of the movement bits 1 and 2, holds of the attack bit 4."""
    out = {}
    for slot, _, start, end, _ in windows:
        known = boundary = reload = begun = ended = run = longest = 0
        before, last, gap, n = None, None, 0, 0
        for _, tick, _, p1, p2, p3, there in sorted((c for c in commands if c[0] == slot and c[1] is not None and start <= c[1] < end), key=lambda c: (c[1], c[2])):
            n += 1
            gap = max(gap, tick - (start if last is None else last))
            last = tick
            if not there or None in (p1, p2, p3):
                before, run = None, 0
                continue
            known += 1
            follows = before is not None and tick - before[0] <= 2
            boundary += not follows
            inside = tick >= start + margin
            reload += inside and bool((p1 | p2 | p3) & 16)
            if follows and inside and before[1] & 3 == (p1 ^ p2) & 3:
                begun += not before[1] & 3 and bool(p1 & 3)
                ended += bool(before[1] & 3) and not p1 & 3
            steady = bool(p1 & 4) and not (p2 | p3) & 4
            run = run + 1 if steady and follows and before[1] & 4 else int(steady)
            longest = max(longest, run if inside else 0)
            before = (tick, p1)
        gap = None if last is None else max(gap, end - last)
        out[slot, start] = (n, known, boundary, reload, begun, ended, longest, longest >= sustained, gap, gap is not None and gap <= allowed)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_discovery_state_by_state(spark, seed):
    rng = random.Random(seed)
    ticks = [(slot, t) for slot in range(4) for t in range(120) if rng.random() < 0.95]
    states = [(slot, t, rng.choice([True] * 20 + [False, None]), rng.choice(["a"] * 15 + ["b", None]) if slot else "a", rng.choice([None, 1, 2, 3])) for slot, t in ticks]
    commands = [(rng.randrange(5), rng.choice([*range(120), None]), i, rng.choice([None, *range(32)]), rng.choice([0, 0, *range(8)]), rng.choice([0, 0, 4, 16]), rng.choice([True] * 9 + [None])) for i in range(900)]
    df = spark.createDataFrame(states, "slot int, t long, ok boolean, who string, health int").repartition(3)
    rows = spark.createDataFrame(commands, "slot int, t long, id int, p1 long, p2 long, p3 long, there boolean").repartition(3)
    found = discovery.state_windows(df, ["slot"], "t", C("ok"), ["who"], 6, 2, {"falls": lambda before: C("health") < before("health")})
    want = plain_windows([(s, t, bool(ok), who, h) for s, t, ok, who, h in states], 6, 2)
    assert sorted(map(str, found.select("slot", "who", "start", "end", "falls").collect())) == sorted(f"Row(slot={s}, who={w!r}, start={a}, end={b}, falls={f})" for s, w, a, b, f in want)
    assert len(want) > 10
    near = lambda before: C("t") - before("t") <= 2
    out = discovery.action_hints(found, rows, ["slot"], "t", ["t", "id"], ["p1", "p2", "p3"], C("there"), near, {"reload": 16}, [1, 2], 4, 2, 3, 2)
    names = ["commands", "known", "boundary_gaps", "reload", "movement_start", "movement_stop", "attack_run", "sustained_attack", "max_gap", "covered"]
    assert {(r["slot"], r["start"]): tuple(r[n] for n in names) for r in out.collect()} == plain_hints(want, commands, 2, 3, 2)
    report = discovery.coverage_report(out, [], ["reload", "sustained_attack"]).first()
    assert report["candidates"] == len(want) and report["eligible_reload"] <= report["n_reload"]
    keyed = out.withColumns({"key": F.concat_ws(":", "slot", "start"), "source": F.lit("one")})
    picks = discovery.choose(keyed, "key", "source", "who", "slot", ["reload", "sustained_attack"], 5)
    covered = {r["key"] for r in keyed.where("covered").collect()}
    assert len(set(picks)) == len(picks) == min(5, len(covered)) and set(picks) <= covered
    assert discovery.action_hints(found, rows.limit(0), ["slot"], "t", ["t", "id"], ["p1", "p2", "p3"], C("there"), near, {"reload": 16}, [1, 2], 4, 2, 3, 2).where("commands > 0 OR covered OR max_gap IS NOT NULL").count() == 0
    assert discovery.state_windows(df.limit(0), ["slot"], "t", C("ok"), ["who"], 6, 2, {}).count() == 0


def test_pairs_are_unique_on_both_sides(spark):
    left = spark.createDataFrame([(1, 1, 5), (1, 2, 6), (1, 2, 7), (1, 3, 8), (None, 4, 9)], "k int, t int, v int")
    right = spark.createDataFrame([(1, 1, 50), (1, 2, 60), (2, 1, 70), (None, 4, 90)], "k int, t int, v int")
    got = {(r["k"], r["t"], r["status"], r["left_v"], r["right_v"]) for r in joins.paired_once(left, right, ["k", "t"], "v").collect()}
    assert got == {(1, 1, "matched", 5, 50), (1, 2, "ambiguous", None, None), (1, 3, "left_only", None, None), (2, 1, "right_only", None, None), (None, 4, "left_only", None, None), (None, 4, "right_only", None, None)}


def test_button_proofs_command_by_command(spark):
    rng = random.Random(5)
    masks = {"a": 1, "b": 4}
    rows = [(rng.choice(["x", "y"]), i, 2 * i + rng.choice([0, 0, 5]), rng.choice([None, *range(8)]), rng.choice([0, *range(8)]), rng.choice([None, 0, 4]), rng.choice([True] * 6 + [False, None]), rng.choice([True] * 8 + [False, None])) for i in range(400)]
    df = spark.createDataFrame(rows, "k string, id int, t int, p1 long, p2 long, p3 long, parent boolean, bound boolean").repartition(3)
    want, before, tally = {}, {}, Counter()
    for k, i, t, p1, p2, p3, parent, bound in rows:
        q = [p or 0 for p in (p1, p2, p3)] if parent else None
        old = before.get(k)
        before[k] = (t, q)
        met = q is not None and old is not None and old[1] is not None and 0 <= t - old[0] <= 6
        odd = [n for n, m in masks.items() if met and bool(old[1][0] & m) != bool((q[0] ^ q[1]) & m)]
        why = (["button_parent_unknown"] if parent is None else [] if parent else ["missing_button_parent"]) + ([] if bound else ["source_not_bound"])
        status = "verified" if not why and len(odd) < 2 else "unknown"
        codes = None if q is None else {n: sum(1 << j for j in range(3) if q[j] & m) for n, m in masks.items()}
        want[i] = (codes, 2 if met else 0, odd, why, status)
        for n, c in (codes or {}).items():
            tally[k, n, c, "n"] += 1
            tally[k, n, c, "verified"] += status == "verified" and n not in odd
    out = buttons.button_proofs(df, ["k"], "id", ["p1", "p2", "p3"], C("parent"), C("bound"), {"t": (0, 6)}, masks)
    assert out.columns[: len(df.columns)] == df.columns
    assert {r["id"]: (r["codes"], r["compared"], r["contradicted"], r["reason_codes"], r["status"]) for r in out.collect()} == want
    assert {(r["k"], r["button"], r["code"]): (r["n"], r["verified"]) for r in buttons.state_counts(out, ["k"]).collect()} == {x[:3]: (tally[*x[:3], "n"], tally[*x[:3], "verified"]) for x in tally}
    whole = buttons.proof_summary(out, []).first()
    assert (whole["verified"], whole["comparisons"], whole["mismatches"]) == (sum(v[4] == "verified" for v in want.values()), sum(v[1] for v in want.values()), sum(len(v[2]) for v in want.values()))
    assert buttons.button_proofs(df.limit(0), ["k"], "id", ["p1", "p2", "p3"], C("parent"), C("bound"), {"t": (0, 6)}, masks).count() == 0


def test_dispatches_row_by_row(spark):
    rng = random.Random(9)
    plan = [(r, i, rng.choice("+-"), 10 * i) for r in "xy" for i in range(60)]
    log, n = [], 0
    for r, i, command, at in plan:
        for _ in range(rng.choice([0, 1, 1, 1, 1, 2])):
            n += 1
            elapsed = rng.choice([at + 1] * 6 + [at - 2, None, -1, at + 30])
            wall = 5 * n + rng.choice([0] * 8 + [-9])
            log.append((r, n, rng.choice([i] * 9 + [i + 1000]), rng.choice([command] * 9 + ["?"]), at, elapsed, rng.choice([elapsed] * 5 + [at]), wall, rng.choice([wall + 2] * 8 + [wall - 1, None])))
    due = {(r, i): (c, at) for r, i, c, at in plan}
    want, seen, last, end = {}, set(), {}, {}
    for r, n, i, command, at, elapsed, other, begun, ended in log:
        matched = (r, i) not in seen and due.get((r, i)) == (command, at)
        seen.add((r, i))
        valid, fine = elapsed is not None and elapsed >= 0, ended is not None and ended >= begun
        same = valid and elapsed == other
        late = elapsed - at if matched and same else None
        issues = [k for k, x in {"invalid_elapsed": not valid, "elapsed_regressed": valid and elapsed < last.get(r, 0), "clocks_disagree": not same, "invalid_wall": not fine, "wall_regressed": fine and begun < end.get(r, begun), "not_as_planned": not matched, "early": late is not None and late < 0}.items() if x]
        want[n] = (matched, same, late, ended - begun if fine else None, issues)
        last[r] = elapsed if valid else last.get(r, 0)
        end[r] = ended if fine else end.get(r, begun)
    p = spark.createDataFrame(plan, "run string, id int, command string, at long")
    rows = spark.createDataFrame(log, "run string, n int, id int, command string, at long, elapsed long, other long, wall_before long, wall_after long").repartition(3)
    out = dispatch.dispatches(p, rows, ["run"], C("other"))
    assert {r["n"]: (r["matched"], r["consistent"], r["lateness"], r["call"], r["issues"]) for r in out.collect()} == want
    report = {r["run"]: r for r in dispatch.dispatch_report(p, out, ["run"]).collect()}
    for r in "xy":
        mine = [(x, want[x[1]]) for x in log if x[0] == r]
        late = [w[2] for _, w in mine if w[2] is not None]
        assert (report[r]["planned"], report[r]["dispatched"], report[r]["matched"], report[r]["in_order"]) == (60, len(mine), sum(w[0] for _, w in mine), False)
        assert (report[r]["missing"], report[r]["middle"], report[r]["most"]) == (60 - len({x[2] for x, _ in mine} & set(range(60))), statistics.median(late), max(late))
    exact = spark.createDataFrame([("x", i, i, "+", at, at, at, i, i) for i, (r, _, _, at) in enumerate(plan) if r == "x"], rows.schema)
    only = spark.createDataFrame([("x", i, "+", at) for r, i, _, at in plan if r == "x"], p.schema)
    good = dispatch.dispatch_report(only, dispatch.dispatches(only, exact, ["run"], C("other")), ["run"]).first()
    assert good["in_order"] and (good["matched"], good["missing"], good["with_issues"], good["most"]) == (60, 0, 0, 0)
    nothing = dispatch.dispatch_report(only, dispatch.dispatches(only, exact.limit(0), ["run"], C("other")), ["run"]).first()
    assert (nothing["planned"], nothing["dispatched"], nothing["missing"], nothing["in_order"], nothing["most"]) == (60, 0, 60, False, None)


def test_holds_row_by_row(spark):
    rng = random.Random(4)
    rows = [(rng.choice("xy"), i, rng.choice("ab"), rng.choice([True, True, False, False, None]), 3 * i) for i in range(300)]
    held, want = {}, {}
    for run, n, control, pressed, at in rows:
        key = run, control
        if pressed is None:
            continue
        if pressed:
            want[n] = ("duplicate_press" if key in held else "not_released", None, None)
            if key not in held:
                held[key] = n, at
        elif key in held:
            first, since = held.pop(key)
            want[n], want[first] = ("paired", first, at - since), ("held", None, None)
        else:
            want[n] = ("without_press", None, None)
    df = spark.createDataFrame(rows, "run string, n int, control string, down boolean, at long").repartition(3)
    assert {r["n"]: (r["status"], r["press"], r["hold"]) for r in dispatch.holds(df, ["run"], "control", "down", "at").collect()} == want


# ---- what a key costs


class Handle:
    """A state store of one key that counts the messages of its processor."""

    def __init__(self):
        self.n, self.held, self.timers = 0, {}, set()

    def _var(self, name, empty):
        def call(f):
            def g(*a):
                self.n += 1
                return f(*a)

            return g

        put, get = lambda x: self.held.__setitem__(name, x), lambda: self.held.get(name, empty() if empty else None)
        return type("Var", (), {"get": staticmethod(call(lambda: iter(get()) if empty else get())), "put": staticmethod(call(put)), "update": staticmethod(call(put)), "clear": staticmethod(call(lambda: self.held.pop(name, None))), "exists": staticmethod(call(lambda: name in self.held)), "appendList": staticmethod(call(lambda x: put([*get(), *x])))})

    def getListState(self, name, _):  # noqa: N802
        return self._var(name, list)

    def getValueState(self, name, _):  # noqa: N802
        return self._var(name, None)

    def registerTimer(self, at):  # noqa: N802
        self.n += 1
        self.timers.add(at)

    def deleteTimer(self, at):  # noqa: N802
        self.n += 1
        self.timers.discard(at)

    def listTimers(self):  # noqa: N802
        self.n += 1
        return iter(self.timers)


def test_sessions_send_few_messages_a_key():
    """A message to the state store costs more than a row: five a batch at most, and none is left where nothing waits."""
    from pyspark.sql import Row

    handle, p = Handle(), processors.Sessions(60_000_000)
    p.init(handle)
    clock = lambda ms: type("T", (), {"getCurrentWatermarkInMs": staticmethod(lambda: ms)})
    out = []
    for batch, watermark in enumerate((0, 100_000, 200_000)):
        handle.n = 0
        rows = [Row(key=1, ts=None, s_at=(batch * 100 + i + 1) * 1_000_000, s_tie=i, s_state="in") for i in range(0, 100, 10)]
        out += list(p.handleInputRows((1,), iter(rows), clock(watermark)))
        assert handle.n <= 5 and len(handle.timers) == 1
    handle.n, fired = 0, handle.timers.pop()
    out += list(p.handleExpiredTimer((1,), clock(10_000_000), fired))
    assert handle.n <= 5 and not handle.timers and not handle.held
    assert [tuple(zip(r["start"], r["last"], r["n"], strict=True)) for r in out] == [((1_000_000, 291_000_000, 30),)]


def test_epochs_keep_whole_numbers_and_unknown_values(spark, tmp_path):
    """Values beyond 2 ** 53 stay as they are; a reset without a value begins an epoch and counts as none."""
    rows = [(1, 0, 0, "b", 2**53 + 1), (1, 1, 1, "a", None), (1, 2, 2, "b", -5), (1, 3, 3, "c", 7)]
    df = spark.createDataFrame(rows, "key int, t long, id long, item string, v long")
    df.coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in")
    with rocks(spark):
        got = drained(spark, processors.stream_epochs(stream, "key", "t", "id", C("item") == "a", C("item") == "c", "v"), "append", f"{tmp_path}/run")
    most = 2**53 + 1
    assert sorted((r["id"], r["epoch"], r["in_epoch"], r["lifetime"]) for r in got.collect()) == [(0, 0, most, most), (1, 1, None, most), (2, 1, -5, most), (3, 1, -5, most)]


def test_rows_are_packed_for_the_state(monkeypatch):
    """A key's rows are one row in their order, however many batches they come in and wherever these are cut; whole numbers
    stay what they are beside nulls, and a null place comes last."""
    import pickle

    import pyarrow as pa

    schema = pa.schema([("k", pa.string()), ("s_a", pa.int64()), ("s_b", pa.int64()), ("s_item", pa.string()), ("s_value", pa.int64())])
    rows = [("x", 2, 1, "b", 2**53 + 1), ("y", 1, 1, None, None), ("x", None, 7, "n", 3), ("x", 1, 9, "a", None), ("y", 0, 4, "c", -5), ("x", 2, 0, "d", 0)]
    batches = [pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows[i : i + 2]], schema) for i in range(0, 6, 2)]
    packs = lambda: [(r["s_key"], list(zip(*pickle.loads(r["s_rows"]), strict=True))) for b in processors._packed(iter([batches[0].slice(0, 0), *batches])) for r in b.to_pylist()]
    x = [(1, 9, "a", None), (2, 0, "d", 0), (2, 1, "b", 2**53 + 1), (None, 7, "n", 3)]
    assert packs() == [("x", x), ("y", [(0, 4, "c", -5), (1, 1, None, None)])]
    monkeypatch.setattr(processors, "PACKED", 3)
    assert packs() == [("x", [x[0], x[2], x[3]]), ("y", [(1, 1, None, None)]), ("x", [x[1]]), ("y", [(0, 4, "c", -5)])]


def test_ordered_processors_send_two_messages_a_key():
    """A key's packs of a batch cost two messages to the state store, in whatever order they come, and only one where all
    rows are late; those and rows without a place come out with nulls."""
    import pickle

    from pyspark.sql import Row

    handle, p = Handle(), processors.Epochs()
    p.init(handle)

    def batch(*packs):
        handle.n = 0
        out = p.handleInputRows((1,), iter([Row(s_key=1, s_rows=pickle.dumps([list(c) for c in zip(*rows, strict=True)])) for rows in packs]), None)
        return sorted(x for r in out for x in zip(r["s_b"], r["epoch"], r["in_epoch"], r["lifetime"], strict=True))

    assert batch([(3, 3, "reset", None)], [(1, 1, "value", 9), (2, 2, "ignored", 50), (None, 0, "value", 70)]) == [(0, None, None, None), (1, 0, 9, 9), (2, 0, 9, 9), (3, 1, None, 9)]
    assert handle.n == 2
    assert batch([(3, 3, "value", 80), (3, 4, "value", 4), (4, 5, "value", 2)]) == [(3, None, None, None), (4, 1, 4, 9), (5, 1, 4, 9)]
    assert handle.n == 2
    assert batch([(1, 6, "value", 99)]) == [(6, None, None, None)]
    assert handle.n == 1
