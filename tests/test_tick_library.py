"""Golden cases and awkward inputs of the tick library; the queries themselves are held against DuckDB."""

import json
import math
import struct

import duckdb
import pytest
from pyspark.sql import functions as F

from tideline.functions import angles, bits, names, wire
from tideline.operators import aggregates, audits, filters, intervals, joins, samples, selection, windows
from tideline.plans import tick_queries
from tideline.sources import sinks, tables

C = F.col
SF = "/root/testdata/sf0.001"


def one(spark, expression):
    return spark.range(1).select(expression.alias("x")).first()["x"]


@pytest.mark.parametrize(("d", "turn"), [(-358.0, 2.0), (358.0, -2.0), (180.0, -180.0), (-180.0, -180.0), (0.0, 0.0), (725.0, 5.0)])
def test_wrap(spark, d, turn):
    assert one(spark, angles.wrap_degrees(F.lit(d))) == turn


@pytest.mark.parametrize("d", [-180.0 + 2**-45, -180.0 + 2**-44, 180.0 + 2**-45, 180.0 - 2**-45, 540.0 + 2**-43, -540.0 - 2**-43])
def test_wrap_rounds_as_its_sql(spark, d):
    """Half turns that the difference of two angles puts off by a last bit: the same on both sides, to that bit."""
    assert one(spark, angles.wrap_degrees(F.lit(d))) == math.fmod(math.fmod(d + 180.0, 360.0) + 360.0, 360.0) - 180.0


@pytest.mark.parametrize(("x", "ok"), [(1.5, True), (float("nan"), False), (float("inf"), False), (float("-inf"), False), (None, False)])
def test_finite(spark, x, ok):
    assert one(spark, angles.finite(F.lit(x).cast("double"))) is ok


@pytest.mark.parametrize(("present", "value"), [(None, None), (False, None), (True, 0)])
def test_absence_is_not_zero(spark, present, value):
    assert one(spark, angles.default_when_present(F.lit(None).cast("int"), F.lit(present).cast("boolean"))) == value


def row(**changed):
    return {"row_id": 2, "slot": 1, "round_id": 1, "user_id": 7, "alive": True, "yaw": -179.0, "pitch": 5.0, "tick": 11, "number": 11, "client_tick": 21} | changed


@pytest.mark.parametrize(
    ("changed", "reason"),
    [
        ({}, None), ({"round_id": 2}, "changed_round_id"), ({"user_id": 8}, "changed_user_id"), ({"alive": False}, "not_alive"), ({"alive": None}, None), ({"yaw": None}, "missing_viewangles"),
        ({"yaw": float("nan")}, "missing_viewangles"), ({"tick": 30}, "demo_tick_discontinuity"), ({"tick": 9}, "demo_tick_discontinuity"), ({"number": 9}, "command_number_discontinuity"), ({"client_tick": 19}, "client_tick_reset"),
    ],
)
def test_transition_reasons(spark, changed, reason):
    rows = [row(row_id=1, yaw=179.0, pitch=2.0, tick=10, number=10, client_tick=20), row(**changed)]
    schema = "row_id long, slot int, round_id int, user_id long, alive boolean, yaw double, pitch double, tick long, number long, client_tick long"
    got = windows.transitions(spark.createDataFrame([tuple(r[c.split()[0]] for c in schema.split(", ")) for r in rows], schema)).orderBy("row_id").collect()
    assert got[0]["reset_reason"] == "first_command"
    assert got[1]["reset_reason"] == reason
    assert (got[1]["delta_yaw"], got[1]["delta_pitch"]) == ((2.0, 3.0) if reason is None else (None, None))


def test_unsigned_planes(spark):
    big = spark.sql("SELECT 18446744073709551615BD AS x UNION ALL SELECT 9223372036854775808BD UNION ALL SELECT 5BD").select(bits.signed_plane(C("x").cast("decimal(20,0)")).alias("x"))
    assert sorted(r["x"] for r in big.collect()) == [-(2**63), -1, 5]


def test_split_is_stable(spark):
    import hashlib

    got = {r["k"]: r["b"] for r in spark.range(50).select(C("id").cast("string").alias("k"), names.bucket("seed", C("id")).alias("b")).collect()}
    assert all(b == int(hashlib.sha256(f"seed:{k}".encode()).hexdigest(), 16) % 10_000 for k, b in got.items())


@pytest.mark.parametrize(("text", "n"), [("1:2,5:9", 2), ("5:9,1:2", 2), ("1:4,3:9", None), ("4:4", None), ("x:1", None), ("1", None)])
def test_windows_text(spark, text, n):
    got = one(spark, names.parse_windows(F.lit(text)))
    assert (None if got is None else len(got)) == n


def test_interval_join_edges(spark):
    points = spark.createDataFrame([(0,), (9,), (10,), (25,), (None,), (-1,)], "t long")
    spans = spark.createDataFrame([(0, 10, "a"), (10, 30, "b"), (5, 5, "none"), (None, 4, "open")], "start long, end long, name string")
    left = sorted((r["t"], r["name"]) for r in joins.interval_join(points, spans, "t", width=4).collect())
    assert left == [(0, "a"), (9, "a"), (10, "b"), (25, "b")]
    right = sorted((r["t"], r["name"]) for r in joins.interval_join(points, spans, "t", closed="right", width=4).collect())
    assert right == [(9, "a"), (10, "a"), (25, "b")]


def test_unique_and_offsets(spark):
    left = spark.createDataFrame([(1,), (2,), (3,), (None,)], "k long")
    right = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (None, "d")], "k long, v string")
    got = {r["k"]: (r["status"], r["v"]) for r in joins.unique_join(left, right, ["k"], ["v"]).collect()}
    assert got == {1: ("matched", "a"), 2: ("ambiguous", None), 3: ("missing", None), None: ("missing", None)}


def test_compare_tables_nan(spark):
    a = spark.createDataFrame([(1, float("nan")), (2, 1.0), (3, None)], "k long, v double")
    b = spark.createDataFrame([(1, float("nan")), (2, 2.0), (4, None)], "k long, v double")
    got = {r["k"]: r["status"] for r in joins.compare_tables(a, b, "k", ["v"]).collect()}
    assert got == {2: "changed", 3: "missing_right", 4: "missing_left"}


def test_islands_and_chunks(spark):
    rows = spark.createDataFrame([(1, t, t != 7) for t in [1, 2, 3, 6, 7, 8, 20]], "slot int, tick long, ok boolean")
    got = sorted((r["start"], r["end"], r["n"]) for r in windows.gap_islands(rows, ["slot"], "tick", C("ok"), [], 4).collect())
    assert got == [(1, 7, 4), (8, 9, 1), (20, 21, 1)]
    assert sorted(r["tick"] for r in windows.chunks(rows, ["slot"], "tick", 3).collect()) == [1, 2, 3, 6, 7, 8]


def test_union_and_complement(spark):
    rows = spark.createDataFrame([("a", 5, 9), ("a", 1, 3), ("a", 2, 4), ("a", 9, 12), ("b", 0, 20)], "k string, start long, end long")
    union = windows.running_segments(rows, ["k"], "start", "end")
    assert sorted((r["k"], r["start"], r["end"]) for r in union.collect()) == [("a", 1, 4), ("a", 5, 12), ("b", 0, 20)]
    rest = intervals.complement(union, 0, 20, ["k"])
    assert sorted((r["k"], r["start"], r["end"]) for r in rest.collect()) == [("a", 0, 1), ("a", 4, 5), ("a", 12, 20)]


def cuts(start, end, most, history, least, floor):
    s = max(floor, start)
    e = s + (end - s) // 2 * 2
    out, cursor = [], s
    while e - s >= least and cursor < e:
        begin = cursor if cursor == s else cursor - history
        stop = min(e, begin + most)
        if 0 < e - stop < history + 4:
            stop -= history + 4 - (e - stop)
        out.append((cursor, stop, begin))
        cursor = stop
    return out


def test_split_windows(spark):
    spans = [(i, 100 + i, 100 + i + n) for i, n in enumerate([*range(0, 90), 200, 399, 400, 1234])]
    got = {}
    for r in intervals.split(spark.createDataFrame(spans, "id long, start long, end long"), 60, 14, 32, floor=120).orderBy("id", "piece").collect():
        got.setdefault(r["id"], []).append((r["owned_start"], r["owned_end"], r["capture_start"]))
    for i, a, b in spans:
        assert got.get(i, []) == (cuts(a, b, 60, 14, 32, 120) if b > 120 else [])


def test_causal_targets(spark):
    frames = spark.createDataFrame([(i, 100 + 2 * i - 2, 100 + 2 * i) for i in range(12)], "frame_index long, start long, end long")
    commands = spark.createDataFrame([(1000 + i, 100 + i) for i in range(27)], "row_id long, tick long")
    got = {r["frame_index"]: r for r in samples.causal_targets(frames, commands, "tick", 8, 3, 2).collect()}
    assert [i for i, r in sorted(got.items()) if not r["reason_codes"]] == [7, 8, 9]
    seven = got[7]
    assert (seven["upper"], seven["cutoff"], seven["target"], seven["gap"], seven["remaining"], seven["overlapping"]) == (114, 118, 1016, 1, 2, 2)


def test_labels_mask(spark):
    label = lambda *p: one(spark, samples.button_label(*[[F.lit(x).cast("long") for x in q] for q in p], 4))
    assert label([0, 4, 4], [0, 4, 0], [0, 0, 0])["net_pressed"] is True
    assert label([0, 4, 4], [0, 0, 0], [0, 0, 0]).asDict() == dict.fromkeys(["held_end", "net_changed", "net_pressed", "net_released", "rapid", "activity"])
    unknown = label([None, 4, 4], [0, None, 0], [0, 4, 0])
    assert unknown["held_end"] is True and unknown["net_changed"] is None and unknown["rapid"] is True and unknown["activity"] is True


def test_three_valued(spark):
    t, f, u = (F.lit(x).cast("boolean") for x in (True, False, None))
    assert [one(spark, bits.any_true(*c)) for c in ((u, t), (u, f), (f, f))] == [True, None, False]
    verdicts = [one(spark, bits.verdict(*(F.lit(x) for x in v))) for v in ((0, 0, 0), (3, 0, 3), (3, 1, 2), (3, 0, 2))]
    assert verdicts == ["unknown", "passed", "failed", "unknown"]


def test_empty_inputs(spark):
    none = spark.createDataFrame([], "slot int, tick long, ok boolean, start long, end long, cents long")
    assert windows.gap_islands(none, ["slot"], "tick", C("ok"), [], 4).count() == 0
    assert aggregates.median_and_mad(none, ["slot"], "cents").count() == 0
    assert intervals.overlapping(none, ["slot"]).count() == 0
    assert audits.repeated_keys(none, ["slot"]).count() == 0
    assert selection.diverse(none.withColumn("k", C("tick")), "k", "slot", "tick", 5) == []
    assert filters.in_any_window(none, none.select("start", "end"), "tick").count() == 0


def test_clean_name_of_whole_text(spark, tmp_path):
    from tideline.plans.filter_queries import fn_s4_clean_name

    texts = [(1, " " * 300 + "late name"), (2, "a" + "\n " * 200 + "b" * 120), (3, None), (4, " \t ")]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r["name"] for r in fn_s4_clean_name(spark, str(tmp_path)).collect()}
    assert got == {1: "late name", 2: "a " + "b" * 98, 3: None, 4: ""}


def test_diverse_picks(spark):
    """Against the plain walk over every row; a source whose rows all come late by hash has its turn."""
    import hashlib
    import math
    from collections import Counter

    h = lambda k: hashlib.sha256(str(k).encode()).hexdigest()
    late = sorted(range(6000), key=h)[-3:]
    rows = [(k, "rare" if k in late else f"s{k % 3}", k % 5 if k % 11 else None, k if k not in late else -1, k % 97 == 0, k % 2 == 0 if k % 7 else None) for k in range(6000)]
    df = spark.createDataFrame(rows, "k long, source string, round int, player long, scarce boolean, usual boolean")
    plain = selection.diverse(df, "k", "source", "player", 12)
    assert set(plain[:4]) & set(late) and len(set(plain)) == 12
    counts, covered, left, want = Counter(), Counter(), list(rows), []
    for i in range(24):
        order = lambda r: (counts[r[1]], counts["r", r[1], r[2]], counts["p", r[1], r[3]], h(r[0]))
        some = left
        if i >= math.ceil(24 * 0.25):
            held = [a for a in (4, 5) if any(r[a] for r in left)]
            action = min(held, key=lambda a: (covered[a], a))
            some = [r for r in left if r[action]]
        best = min(some, key=order)
        left.remove(best)
        want.append(best[0])
        counts.update([best[1], ("r", best[1], best[2]), ("p", best[1], best[3])])
        covered.update(a for a in (4, 5) if best[a])
    assert selection.diverse(df, "k", "source", "player", 24, "round", {"scarce": C("scarce"), "usual": C("usual")}, 0.25) == want
    for near in (1, 30, 400):  # what lies beyond is looked at where it may come first
        assert selection.diverse(df, "k", "source", "player", 24, "round", {"scarce": C("scarce"), "usual": C("usual")}, 0.25, near) == want
    few = df.where("k < 3")
    assert len(selection.diverse(few, "k", "source", "player", 9, "round", {"none": F.lit(False)})) == 3


def test_wire():
    def field(n, kind, body):
        return bytes([n << 3 | kind]) + body

    data = field(1, 0, b"\x96\x01") + field(2, 2, b"\x03abc") + field(3, 5, struct.pack("<f", 1.5)) + field(1, 0, b"\x01")
    assert wire.fields(data) == [(1, 0, 150, None), (2, 2, None, b"abc"), (3, 5, None, struct.pack("<f", 1.5)), (1, 0, 1, None)]
    assert wire.signed32((1 << 64) - 5) == -5
    for bad in (b"\x80", b"\x00\x01", b"\x0a\x05ab", b"\x0f\x01"):
        with pytest.raises(wire.WireError):
            wire.fields(bad)
    with pytest.raises(wire.WireError):
        wire.signed32(1 << 32)
    assert wire.snappy_raw(b"\x03\x08abc") == b"abc"
    assert wire.snappy_raw(b"\x08\x04ab" + bytes([(6 - 4) << 2 | 1, 2])) == b"abababab"


def test_wire_udfs(spark):
    rows = spark.createDataFrame([(1, bytearray(b"\x08\x96\x01")), (2, bytearray(b"\x80")), (3, None)], "id int, data binary")
    got = {r["id"]: r["f"] for r in rows.select("id", wire.decode_fields("data").alias("f")).collect()}
    assert int(got[1][0]["number"]) == 150 and got[2] is None and got[3] is None
    signs = spark.createDataFrame([(0.0,), (-0.0,), (None,)], "x double").select(wire.double_bits("x").alias("b")).collect()
    assert [r["b"] for r in signs] == [0, -(2**63), None]


def test_wire_reasons(spark, monkeypatch):
    """Each reason that forbids fields is told, and a value has either fields or a reason."""
    cases = {None: "no value", b"\x80": "a varint does not end", b"\x00\x01": "field 0", b"\x0a\x05ab": "a field is cut off", b"\x0f\x01": "an unknown wire type", b"\x08" + b"\xff" * 9 + b"\x7f": "a varint is over 64 bits", b"\x08\x01": None, b"": None}
    cases |= {b"\x0a" + b"\x81\x80\x80\x02" + b"a" * ((4 << 20) + 1): "too long", b"\x08\x01" * 100_001: "too many fields"}
    rows = spark.createDataFrame([(i, None if x is None else bytearray(x)) for i, x in enumerate(cases)], "id int, data binary")
    got = rows.select("id", wire.decoded("data").alias("x")).select("id", "x.reason", F.size("x.fields").alias("n")).collect()
    assert {r["id"]: r["reason"] for r in got} == dict(enumerate(cases.values())) and set(cases.values()) - {None} == set(wire.REASONS)
    assert {r["n"] for r in got if r["reason"] is None} == {0, 1}


def test_sources(spark, tmp_path):
    frame = spark.createDataFrame([(1, 2)], "a long, b long")
    sinks.publish({"t": frame}, f"{tmp_path}/out", {"rows": 1})
    assert sinks.is_complete(spark, f"{tmp_path}/out") and json.loads((tmp_path / "out/report.json").read_text()) == {"rows": 1}
    with pytest.raises(FileExistsError):
        sinks.publish({"t": frame}, f"{tmp_path}/out", {})
    assert tables.read_table(spark, f"{tmp_path}/out/t", ["b"]).columns == ["b"]
    with pytest.raises(tables.SchemaError):
        tables.read_table(spark, f"{tmp_path}/out/t", ["c"])
    with pytest.raises(tables.SchemaError):
        tables.read_bounded(spark, f"{tmp_path}/out/t", ["a"], 0)
    digests = tables.file_digests(spark, f"{tmp_path}/out", "*.parquet").collect()
    tables.verified(spark, f"{tmp_path}/out/t", {digests[0]["path"].rsplit("/", 1)[-1]: digests[0]["sha256"]})
    with pytest.raises(tables.SchemaError):
        tables.verified(spark, f"{tmp_path}/out/t", {"other": "0"})
    for bad in ('{"a": 1, "a": 2}', '{"a": NaN}', "[1]"):
        with pytest.raises(tables.SchemaError):
            tables.strict_json(bad)
    (tmp_path / "ledger.jsonl").write_text('{"event": "header", "n": 0}\n{"event": "frame", "n": 1, "frame_index": 7}\n')
    view = tables.ledger_view(tables.read_ledger(spark, f"{tmp_path}/ledger.jsonl"), ["header"], 5, 9).collect()
    assert [(r["event"], r["view_index"]) for r in view] == [("header", None), ("frame", 2)]
    sinks.partitioned_by_verdict(spark.createDataFrame([(1, True), (2, None)], "id int, ok boolean"), f"{tmp_path}/split", C("ok"))
    assert spark.read.parquet(f"{tmp_path}/split").where("accepted = 'true'").count() == 1


def test_streams(spark, tmp_path):
    from tideline.streaming import stateful

    rows = spark.createDataFrame([(1, "2024-01-01 00:00:00"), (1, "2024-01-01 00:00:30"), (1, "2024-01-01 00:10:00"), (2, "2024-01-01 01:00:00")], "k int, t string").select("k", C("t").cast("timestamp").alias("t"))
    rows.coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in")
    query = stateful.stream_sessions(stream, "k", "t", "1 minute").writeStream.format("memory").queryName("sessions").outputMode("append").start()
    query.processAllAvailable()
    query.stop()
    assert sorted((r["k"], r["n"]) for r in spark.sql("SELECT k, n FROM sessions").collect())[:2] == [(1, 1), (1, 2)]
    done = stateful.resumable(stream, f"{tmp_path}/check", f"{tmp_path}/out").trigger(availableNow=True).start()
    done.awaitTermination(60)
    assert sinks.CommitLog(spark, f"{tmp_path}/out").read(rows.schema).count() == 4


def _plain(v):
    if isinstance(v, float):
        return float(f"{v:.9g}")
    return tuple(_plain(x) for x in v) if isinstance(v, (list, tuple)) else v


#: Labels, loaders, planners and proofs, and what goes through files and streams.
LABELLED = (
    "dom_3_render_jobs", "dom_4_aligned_frames", "dom_15_scoped_proofs", "dom_21_fraction_reasons", "dom_23_causal_acceptance", "dom_24_field_agreement", "dom_26_packet_bounds", "dom_28_chunk_reasons", "dom_31_held_events",
    "dom_34_masked_labels", "dom_36_replay_proof", "dom_38_button_observations", "dom_40_collection", "dom_57_plateau_response", "fn_m6_bitwise_equal", "fn_m8_nan_equal", "fn_h3_typed_digest", "set_5_overlaps",
    "join_23_prefix_lookup", "win_24_frame_cursor", "src_7_ledger", "src_10_gated_source", "snk_6_split_sink", "snk_7_training_shards", "str_3_sessions", "str_6_first_of_key", "str_1_stream_transitions", "udf_2_signed_varints",
)


RESPONSES = ["src_5_json_objects", "src_6_strict_objects", "src_20_merged_events", "snk_4_json_rows", "snk_5_identified_files", "fn_h1_file_digest", "fn_j1_action_schema", "udf_7_uint32_varints", "udf_8_field_reasons", "ord_4_diverse_selection", "ord_2_first_jobs", "src_8_bounded_ledger", "src_25_segment_gate", "src_26_series_groups", "set_4_tails", "dom_58_window_sums", "str_2_out_of_order", "dom_5_clock_calibration", "dom_32_control_audit", "dom_33_samples", "dom_41_budgeted_rounds", "dom_52_pixel_audit", "dom_53_confirmed_hypotheses", "dom_54_command_summary", "dom_55_turns", "dom_56_insertions", "dom_60_effects", "dom_62_compilation", "dom_63_gain_agreement"]
PAIRED = ["join_15_unique_tick", "join_25_frame_proofs", "join_26_table_comparison", "dom_39_coverage", "dom_37_proofs", "dom_37_state_counts", "dom_48_report"]


@pytest.mark.parametrize("name", ["win_1_transitions", "win_5_alive_windows", "win_8_split_windows", "join_17_bracketing", "agg_10_window_coverage", "set_2_complement", "dom_19_causal_targets", "dom_29_button_labels", "fn_h4_stable_split", *LABELLED, *RESPONSES, *PAIRED])
def test_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("events", "nation", "orders", "lineitem", "documents"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.sql(tick_queries.oracle_sql()[name])
    got = tick_queries.queries()[name](spark, SF)
    assert sorted(got.columns) == sorted(want.columns)
    key = lambda rows: sorted((_plain(tuple(r)) for r in rows), key=repr)
    assert key(got.select([f"`{c}`" for c in want.columns]).collect()) == key(want.fetchall())


def test_label_rules(spark):
    from tideline.operators import labels

    rows = spark.createDataFrame([(1, [(0.5,), (None,)]), (2, [(1.0,)]), (3, [(1.5,), None]), (4, None), (5, []), (6, [(float("nan"),)])], "id int, moves array<struct<when: double>>")
    got = {k: {r["id"]: r["r"] for r in rows.select("id", labels.sorted_reasons(labels.fraction_rules(C("moves"), "moves", ["when"], "outside", closed=k)).alias("r")).collect()} for k in (True, False)}
    assert got[True] == {1: [], 2: [], 3: ["invalid_moves", "outside"], 4: ["missing_moves"], 5: [], 6: ["outside"]}
    assert got[False][2] == ["outside"]
    events = spark.createDataFrame([(1, False, [(0, True), (5, False)]), (2, False, [(0, False)]), (3, True, [(9, False), (3, True)]), (4, True, [])], "id int, held boolean, events array<struct<offset: long, pressed: boolean>>")
    got = {r["id"]: r["e"] for r in events.select("id", labels.replay_held(C("held"), C("events")).alias("e")).collect()}
    assert got == {1: [], 2: ["action_event_not_a_transition"], 3: ["action_events_out_of_order"], 4: []}


def test_asof_keeps_whole_numbers(spark):
    from tideline.operators.joins import asof_join

    big = 1 << 60
    left, right = spark.createDataFrame([(1, big), (1, big + 1)], "k int, t long"), spark.createDataFrame([(1, big + 1, 7), (1, big - 1, 6)], "k int, u long, v int")
    assert sorted((r["t"] - big, r["asof_v"]) for r in asof_join(left, right, "t", "u", ("k",), ("v",)).collect()) == [(0, 6), (1, 7)]


def test_effect_and_gain(spark):
    from tideline.operators import responses

    rows = spark.createDataFrame([(1, True, True), (2, True, False), (3, False, True), (4, None, True), (5, True, None)], "id int, known boolean, seen boolean")
    got = {r["id"]: tuple(r["e"]) for r in rows.select("id", responses.effect(C("known"), C("seen"), "no_state").alias("e")).collect()}
    assert got == {1: ("observed_response_evidence", None), 2: ("missing_observed_response", None), 3: ("unknown", "no_state"), 4: ("unknown", "no_state"), 5: ("missing_observed_response", None)}
    cases = [("fits", 2.0, -1.0, 20, -10, 20, -10), ("far", 2.5, 0.0, 20, 0, 20, 0), ("masked", None, 0.0, 20, 0, 20, 0), ("other counts", 2.0, 0.0, 20, 0, 21, 0), ("still", 0.0, 0.0, 0, 0, 0, 0)]
    df = spark.createDataFrame(cases, "case string, yaw double, pitch double, dx long, dy long, ix long, iy long")
    out = responses.gain_agreement(df, ["case"], ["yaw", "pitch"], ["dx", "dy"], ["ix", "iy"], [[0.1, 0.0], [0.0, 0.1]], 0.01, 0.02)
    assert {r["case"]: (r["missing"], r["agrees"]) for r in out.collect()} == {"fits": (0, True), "far": (0, False), "masked": (1, False), "other counts": (0, False), "still": (0, True)}
    assert responses.gain_agreement(df.limit(0), ["case"], ["yaw", "pitch"], ["dx", "dy"], ["ix", "iy"], [[0.1, 0.0], [0.0, 0.1]], 0.01, 0.02).count() == 0


def test_confirmation(spark):
    from tideline.operators import responses

    df = spark.createDataFrame([(True, True, True, None), (True, True, False, None), (False, True, True, True), (False, False, True, False), (None, False, False, False)], "derive boolean, a boolean, b boolean, c boolean")
    got = {r["hypothesis"]: (r["tested"], r["matches"], r["tested_again"], r["matches_again"], r["status"]) for r in responses.confirmed(df, [], C("derive"), {"a": C("a"), "b": C("b"), "c": C("c"), "d": C("derive").isNotNull()}).collect()}
    assert got == {"a": (2, 2, 2, 1, "contradicted"), "b": (2, 1, 2, 2, "rejected"), "c": (0, 0, 2, 1, "untested"), "d": (2, 2, 2, 2, "confirmed")}
    alone = responses.confirmed(df.where("derive"), [], C("derive"), {"a": C("a")}).collect()
    assert [r["status"] for r in alone] == ["unconfirmed"]


def test_whole_clips_and_counts(spark):
    from tideline.operators import responses

    df = spark.createDataFrame([(1, 0, 100), (2, 0, 135), (3, 7, 28), (4, 0, 64)], "id int, start long, end long")
    clips = responses.whole_clips(df, 64, 32)
    assert {r["id"]: (r["n_clips"], r["planned"], r["short"], r["odd"]) for r in clips.collect()} == {1: (2, 100, 0, 0), 2: (2, 128, 6, 1), 3: (0, 0, 20, 1), 4: (1, 64, 0, 0)}
    plan = responses.within_budget(clips, ["id"], 1, 64, 64.0, 10.0, 1.0, 0.0, 1000.0, 0.5)
    assert {r["id"]: r["verdict"] for r in plan.collect()} == {1: "too_many_clips", 2: "too_many_clips", 3: "no_clip", 4: "time_exceeds_budget"}
    want = [0.5, 0.25, -1.25, -1.0, 2.0]
    rows = spark.createDataFrame([(0, i, v) for i, v in enumerate(want)], "slot int, i int, want double")
    got = [(r["emitted"], r["residual"]) for r in responses.compiled_counts(rows, ["slot"], "i", C("want")).orderBy("i").collect()]
    assert got == [(1, -0.5), (0, -0.25), (-2, 0.5), (-1, 0.5), (3, -0.5)]


@pytest.mark.parametrize(
    ("text", "one", "strict"),
    [
        ('{"a":1}', True, True), ('﻿ {"a":{"b":[1]}} ', True, True), ('{"a":1,"a":2}', True, False), ('{"a":{"b":1,"b":2}}', True, False), ("{}", True, True),
        ('{"a":1}}', False, False), ('{"a":1}]', False, False), ('{"a":1},{"b":2}', False, False), ('{"a":1},"b":2', False, False), ('{"a":1} {"b":2}', False, False),
        ("[1]", False, False), ("1", False, False), ("", False, False), ('{"a":NaN}', False, False), ('{"a"', False, False), (None, False, False),
    ],
)
def test_json_objects(spark, text, one, strict):
    row = spark.createDataFrame([(text,)], "t string").select(tables.is_object(tables.without_mark(F.col("t"))).alias("one"), tables.strict_object(F.col("t")).isNotNull().alias("strict")).first()
    assert (row["one"], row["strict"]) == (one, strict)


def test_json_lines_refuse(spark, tmp_path):
    from pyspark.errors import PySparkException

    for i, bad in enumerate((float("nan"), float("inf"), -float("inf"))):
        with pytest.raises(PySparkException, match="x is not finite"):
            sinks.json_lines(spark.createDataFrame([(1.0,), (bad,), (None,)], "x double"), str(tmp_path / f"bad{i}"))
    sinks.json_lines(spark.createDataFrame([(1.0, "NaN"), (None, None)], "x double, y string"), str(tmp_path / "fine"))
    with pytest.raises(PySparkException, match="already exists"):
        sinks.json_lines(spark.createDataFrame([(1.0,)], "x double"), str(tmp_path / "fine"))


@pytest.mark.parametrize(("data", "value"), [(b"\x05", 5), (b"\xac\x02\xff", 300), (b"\xff\xff\xff\xff\x0f", 2**32 - 1), (b"\x80\x80\x80\x80\x10", None), (b"\x80\x80\x80\x80\x80\x01", None), (b"\x80", None), (b"", None), (None, None)])
def test_uint32(spark, data, value):
    assert spark.createDataFrame([(data,)], "d binary").select(wire.uint32(F.col("d"))).first()[0] == value


def test_schema_issues(spark):
    kinds = {"a": "BIGINT", "b": "BOOLEAN|VOID"}
    rows = [('{"a":1,"b":null}', []), ('{"b":1,"c":2}', ["missing:a", "kind:b", "unknown:c"]), ("[]", ["object"]), (None, ["object"])]
    got = spark.createDataFrame([(t,) for t, _ in rows], "t string").select(audits.schema_issues(F.col("t"), kinds)).collect()
    assert [r[0] for r in got] == [x for _, x in rows]


def test_schema_issues_parse_a_text_once(spark):
    """As an entry of a list and of an object, and its keys, however many fields there are."""
    rows = spark.range(1).select(F.col("id").cast("string").alias("t")).select(audits.schema_issues(F.col("t"), {f"f{i}": "BIGINT" for i in range(6)}).alias("x"))
    plan = rows._jdf.queryExecution().analyzed().toString()
    assert (plan.count("parse_json("), plan.count("json_object_keys(")) == (2, 1)
