"""WARC archives, conversation repair and whitening against plain versions in Python."""

import base64
import hashlib
import itertools
import random
import zlib

import numpy as np
import pytest
import zstandard

from tideline.llm import archives, conversation_repair, queries, shared, whitening

# ---- archives


def pages(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], "page_id long, url string, html string, payload string, first int").repartition(3)


def brute_archive(rows, least):
    out, held = [], {}
    for i, (page, _, html) in enumerate(rows):
        held.setdefault((html or "").encode(), []).append((page is None, page or 0, i))
    for payload, members in held.items():
        members.sort()
        first = rows[members[0][2]][0]
        for k, (_, _, i) in enumerate(members):
            revisits = len(payload) >= least and len(members) > 1 and first is not None and k > 0
            digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
            out.append((rows[i][0], len(payload), digest, "revisit" if revisits else "response", first if revisits else None))
    return sorted(out, key=str)


def said(df):
    return sorted((tuple(r) for r in df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)


def awkward_pages():
    rng = random.Random(4)
    some = ["<p>" + " ".join(rng.choice("alpha beta gamma delta ünï 漢字".split()) for _ in range(rng.randrange(5, 200))) + "</p>" for _ in range(60)]
    rows = [(i, f"http://h{i % 7}.example/{i}", t) for i, t in enumerate(some)]
    rows += [(100 + i, "http://copy.example/", some[3]) for i in range(30)] + [(2, "http://again.example/", some[3])]
    rows += [(7, "http://h0.example/7", some[7])] * 3 + [(400, None, None), (401, "http://x/\r\nWARC-Type: evil", ""), (402, "", "x" * 3_000_000)]
    rows += [(None, None, some[5]), (None, "http://n/", "only without ids"), (None, None, "only without ids")]
    return rows


@pytest.mark.parametrize("least", [0, 300])
def test_archives_return_what_was_written(spark, least):
    rows = awkward_pages()
    out = archives.archive_pages(pages(spark, rows), least_bytes=least)
    assert said(out) == brute_archive(rows, least)
    texts = {r["page_id"]: bytes(r["payload"]) for r in out.where("record_type = 'response' and page_id is not null").collect()}
    assert all(v == (dict((i, t) for i, _, t in rows)[k] or "").encode() for k, v in texts.items())
    assert out.where("record_type = 'revisit' and payload is not null").count() == 0


def test_archives_of_many_groups_are_the_same(spark, monkeypatch):
    rows = awkward_pages()
    monkeypatch.setattr(shared, "BROADCAST_GROUPS", 2)
    assert said(archives.archive_pages(pages(spark, rows))) == brute_archive(rows, 0)


def test_archives_are_plain_zstandard(spark, monkeypatch):
    """Dictionary first, one frame a record, files of bounded length, references to records that are there."""
    monkeypatch.setattr(archives, "ROW_BYTES", 2000)
    rows = [(i, f"http://e/{i}", f"<html><body>page number {i} {'some words ' * (i % 40)}</body></html>") for i in range(400)] + [(900, "http://e/", "<html><body>page number 0 </body></html>")]
    path = shared.new_path(spark, "test-archives")
    archives.write_archives(archives.archive_rows(pages(spark, rows)), path, file_rows=2)
    files = [bytes(r["content"]) for r in spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).collect()]
    assert len(files) > 6
    found = []
    for data in files:
        assert data[:4] == archives.DICTIONARY_FRAME
        size = int.from_bytes(data[4:8], "little")
        reader = zstandard.ZstdDecompressor(dict_data=archives.as_dictionary(data[8 : 8 + size]))
        plain = reader.stream_reader(data, read_across_frames=True).read()
        each = list(archives.read_archive(data))
        assert plain == b"".join(r.to_bytes() for r in each)
        assert each[0].headers["WARC-Type"] == "warcinfo"
        found += each[1:]
    ids = {r.headers["WARC-Record-ID"] for r in found}
    assert len(found) == 401 and len(ids) == 401
    assert [r.headers["X-Refers-To-Page-ID"] for r in found if r.headers["WARC-Type"] == "revisit"] == ["0"]
    assert all(r.headers["WARC-Refers-To"] in ids for r in found if r.headers["WARC-Type"] == "revisit")
    spoilt = files[0][:-20] + bytes([files[0][-20] ^ 1]) + files[0][-19:]
    with pytest.raises((zstandard.ZstdError, ValueError)):
        list(archives.read_archive(spoilt))


def test_archives_empty(spark):
    assert archives.archive_pages(pages(spark, [(1, "u", "t")]).where("false")).count() == 0


# ---- conversations


def fault_of(conv, turn):
    return zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20


def brute_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text, f = " " if role is None else role, " " if text is None else text, fault_of(conv, turn)
        if f:
            text = "" if f == 1 else "".join(c for c in text if c not in ".!?") if f == 2 else text
            out += [(conv, turn, "user" if f == 4 else role, text)] * (2 if f == 3 else 1)
    return out


BLANK = " \t\n\x0b\x0c\r"


def brute_repair(rows):
    """Counts, and a shortest path over (rows used, state) with audits, by relaxing until nothing changes."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
    kinds, seen = [], set()
    for _, _, role, text in rows:
        body = text.rstrip(BLANK)
        kinds.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    step = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
    states = {0: (0, "", ())}

    def offer(to, j, way):
        if j not in to or way[:2] < to[j][:2]:
            to[j] = way
            return True
        return False

    def closed(states):
        again = True
        while again:
            again = False
            for i, (c, a, t) in list(states.items()):
                for x, name in (("u", "user:"), ("a", "assistant:")):
                    if i in step[x]:
                        again |= offer(states, step[x][i], (c + 3, a + "I", (*t, name)))
        return states

    for (_, _, role, text), kind in zip(rows, kinds, strict=True):
        states, more = closed(states), 3 if kind == "truncated" else 0
        to = {}
        for i, (c, a, t) in states.items():
            offer(to, i, (c + 4, a + "D", t))
            if kind not in ("blank", "duplicate"):
                if i in step.get(role[:1], {}):
                    offer(to, step[role[:1]][i], (c + more, a + "K", (*t, f"{role}:{text}")))
                for x, name in (("u", "user"), ("a", "assistant")):
                    if i in step[x]:
                        offer(to, step[x][i], (c + 3 + more, a + "R", (*t, f"{name}:{text}")))
        states = to
    cost, audit, texts = min(v for k, v in closed(states).items() if k in (0, 3))
    return {"gaps": gaps, **{k: kinds.count(k) for k in ("blank", "duplicate", "truncated")}, "illegal": illegal, "cost": cost, "audit": audit, "repaired_sha256": hashlib.sha256("\n".join(texts).encode()).hexdigest()}


def awkward_conversations():
    rng, rows = random.Random(9), []
    said_ = ["Fine.", "Yes!", "no end", "", " \t", "A line\n", "Ends. \n", "Is it?", "ünï. ", "x" * 500 + "."]
    for conv in [None, *range(80)]:
        for turn in range(rng.randrange(0, 12)):
            rows.append((conv, rng.choice([turn, turn, turn, turn * 2, None]), rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]), rng.choice([*said_, None, f"Turn {turn}.", f"Turn {turn} of {conv}."])))
    rows += [(500, t, "user" if t % 2 else "assistant", rng.choice(["Fine.", f"Turn {t}.", f"Turn {t}", ""])) for t in range(700)]
    rows += [(501, t, rng.choice(["user", "assistant", "tool"]), f"Turn {t}." if t % 5 else "the same") for t in range(300)]
    seen = set()
    #: Ties of one turn are ordered by a hash beyond 40 characters; the plain version orders them by whole texts.
    return [r for r in rows if (r[0], r[1]) not in seen and not seen.add((r[0], r[1]))] + [(600, None, "user", "b."), (600, None, "user", "a."), (600, None, "assistant", "c.")]


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "clash", 3) for r in rows], "conv_id long, turn long, role string, text string, blank string, rows int").repartition(3)


def brute_by_conversation(rows):
    out = {}
    for r in rows:
        out.setdefault(r[0], []).append(r)
    return {k: brute_repair(v) for k, v in out.items()}


def reports(df):
    return {r["conv_id"]: {k: v for k, v in r.asDict().items() if k != "conv_id"} for r in df.collect()}


@pytest.mark.parametrize(("rows_held", "fan", "parts"), [(4096, 16, 3), (7, 2, 3), (50, 16, 11)])
def test_repair_is_a_shortest_path(spark, monkeypatch, rows_held, fan, parts):
    """Whole conversations, and ones in pieces over several partitions, have the same reports."""
    monkeypatch.setattr(conversation_repair, "PIECE_ROWS", rows_held)
    monkeypatch.setattr(conversation_repair, "FAN", fan)
    monkeypatch.setattr(shared, "BROADCAST_GROUPS", 3 if rows_held == 7 else 1000)
    rows = awkward_conversations()
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        damaged = conversation_repair.damaged(conversations(spark, rows))
        assert sorted(map(str, (tuple(r) for r in damaged.collect()))) == sorted(map(str, brute_damage(rows)))
        report, turns = conversation_repair.repair_conversations(damaged)
        expected = brute_by_conversation(brute_damage(rows))
        assert reports(report) == expected
        texts = {}
        for r in sorted(turns.collect(), key=lambda r: (r["part"], r["piece"])):
            own = texts.setdefault(r["conv_id"], [])
            assert len(own) == r["first"]
            own += [f"{x['role']}:{x['text']}" for x in r["repaired"]]
        assert {k: hashlib.sha256("\n".join(texts.get(k, [])).encode()).hexdigest() for k in expected} == {k: v["repaired_sha256"] for k, v in expected.items()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 3)


def test_matrices_associate():
    """Any way to put brackets around a product is the same, ties of audits too."""
    rng = random.Random(2)
    for _ in range(200):
        kinds = "".join(rng.choice("suaoSUAOx") for _ in range(rng.randrange(1, 9)))
        ones = [conversation_repair.turn_matrix(k) for k in kinds]
        while len(ones) > 1:
            i = rng.randrange(len(ones) - 1)
            ones[i : i + 2] = [conversation_repair.times(ones[i], ones[i + 1])]
        assert ones[0] == conversation_repair.matrix_of(kinds)


def test_repair_of_nothing(spark):
    report, turns = conversation_repair.repair_conversations(conversations(spark, [(1, 1, "user", "a.")]).where("false"))
    assert report.count() == 0 and turns.count() == 0


def test_conversations_that_lose_all_rows_are_reported(spark, tmp_path):
    gone = [c for c in range(2000) if fault_of(c, 0) == 0][:3]
    rows = [(c, 0, "user", "Hello.") for c in gone] + [(5000, t, "user", "Hi.") for t in range(4)]
    conversations(spark, rows).write.parquet(f"{tmp_path}/conversations.parquet")
    out = {r["conv_id"]: r for r in queries.op12_repair(spark, str(tmp_path)).collect()}
    assert set(out) == {*gone, 5000}
    for c in gone:
        assert (out[c]["cost"], out[c]["audit"], out[c]["gaps"], out[c]["repaired_sha256"]) == (0, "", 0, hashlib.sha256(b"").hexdigest())


# ---- whitening


def vectors(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], "vec_id long, embedding array<double>, x string, n int").repartition(3)


def brute_whitening(rows, k=4):
    fine = [(i, v) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    x = np.array([[int(np.floor(256 * c)) for c in v] for _, v in fine], dtype=np.int64)
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(0)
    values, basis = np.linalg.eigh(np.cov(fit.T, bias=True))
    values, basis = values[::-1], basis[:, ::-1][:, :k]
    deviation = [sum((n * int(c) - int(s)) ** 2 for c, s in zip(r, sums, strict=True)) for r in x]
    return [i for i, _ in fine], n, deviation, (x - fit.mean(0)) @ basis / np.sqrt(values[:k]), values[:k] / values.sum()


def check_whitening(spark, rows, **more):
    out = whitening.whiten(vectors(spark, rows), **more).toPandas()
    ids, n, deviation, projected, explained = brute_whitening(rows)
    assert len(out) == 4 * len(ids) and set(out.n) == {n}
    by_id = dict(zip(ids, zip(deviation, projected, strict=True), strict=True))
    for i, group in out.groupby("vec_id"):
        assert set(group.deviation.astype(object).map(int)) == {by_id[i][0]}
    wide = out.drop_duplicates(["vec_id", "component"]).pivot(index="vec_id", columns="component", values="whitened")
    mine, theirs = wide.values, np.array([by_id[i][1] for i in wide.index])
    signs = np.sign((mine * theirs).sum(0))
    assert np.abs(mine * signs - theirs).max() < 1e-8
    assert np.abs(out[out.vec_id == ids[0]].sort_values("component").explained.values[:4] / explained - 1).max() < 1e-9
    assert out.identity_error.max() < 1e-9 and out.identity_error.nunique() == 1


def cloud(n, scales, seed):
    draw = np.random.default_rng(seed)
    basis = np.linalg.qr(draw.normal(size=(len(scales), len(scales))))[0]
    return (draw.normal(size=(n, len(scales))) * scales) @ basis + draw.normal(size=len(scales))


@pytest.mark.parametrize("flat", [False, True])
def test_whitening_is_the_eigenvectors(spark, flat):
    """With a few strong directions, and with none, where the whole covariance is needed; copies count once."""
    scales = np.ones(32) if flat else np.array([30.0, 20, 12, 7] + [0.01] * 28)
    rows = [(i, v) for i, v in enumerate(cloud(600, scales, 5).tolist())]
    rows += [(1000 + i, rows[3][1]) for i in range(400)]
    rows += [(2000, None), (2001, [None] * 32), (2002, [float("nan")] * 32), (2003, [float("inf")] + [0.0] * 31), (2004, [0.0] * 32)]
    check_whitening(spark, rows)


def test_whitening_stops_at_the_range_it_found(spark):
    rows = [(i, v) for i, v in enumerate(cloud(500, np.array([30.0, 20, 12, 7] + [0.02] * 28), 6).tolist())]
    table = shared.stored(whitening.quantised(vectors(spark, rows), "vec_id", "embedding", 256), "q")
    fit = shared.stored(table.select("x").distinct(), "fit")
    strong = whitening.fit_whitening(fit, 32, fit.count())
    weak = whitening.fit_whitening(fit, 32, fit.count(), passes=1)
    assert not strong.full and weak.full and strong.passes <= 10
    assert np.allclose(np.abs((strong.vectors * weak.vectors).sum(0)), 1, atol=1e-12)
    assert np.allclose(strong.values, weak.values, rtol=1e-12)


def test_whitening_of_little(spark):
    """Empty, one vector, copies, low rank, odd sizes, null and repeated ids, exact deviations beyond a long."""
    assert whitening.whiten(vectors(spark, [(1, [1.0])]).where("false")).count() == 0
    assert whitening.whiten(vectors(spark, [(i, [1.0, 2.0]) for i in range(5)])).count() == 0
    line = whitening.whiten(vectors(spark, [(i, [float(i), 2.0 * i]) for i in range(6)] + [(None, [1.0, 2.0]), (3, [3.0, 6.0]), (9, [1.0]), (10, [])])).collect()
    assert {r["component"] for r in line} == {1} and len(line) == 8 and abs(line[0]["explained"] - 1) < 1e-12
    far = whitening.whiten(vectors(spark, [(i, [float(i) * 1e12, float(i % 3)]) for i in range(5)])).where("component = 1").collect()
    x = [(256 * i * 10**12, 256 * (i % 3)) for i in range(5)]
    sums = [sum(c) for c in zip(*x, strict=True)]
    assert {r["vec_id"]: int(r["deviation"]) for r in far} == {i: sum((5 * c - s) ** 2 for c, s in zip(v, sums, strict=True)) for i, v in enumerate(x)}
