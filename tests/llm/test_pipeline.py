"""The pipeline's stages, each on the output of the one before, over a small corpus with planted cases."""

import random
import zlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_operators import brute_groups, brute_hits, prose
from tideline.llm import shared


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(21)
    rows, labels = [], []
    for i in range(900):
        words = prose(rng, rng.randrange(30, 60), 3000).split()
        toxic = int(i % 6 == 0)
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(["vile", "scum", "trash"])
        rows.append((i, " ".join(words), "en", f"s{min(i % 7, 2)}", 0))
        if zlib.crc32(str(i).encode()) % 3 != 1:
            labels.append((i, 1, toxic))
    item = prose(rng, 25, 3000)
    for k in range(8):
        rows.append((1000 + k, rows[7 + 12 * k][1] + (" tail" if k % 2 else ""), "en", "s1", 0))
        rows.append((1100 + k, prose(rng, 20, 3000) + " " + item + " " + prose(rng, 20, 3000), "fr", "s0", 0))
    rows += [(2000, None, "en", None, 0), (2001, "", "en", "s1", 0), (None, "a text without an id", "en", "s0", 0), (7, rows[7][1], "en", "s0", 0)]
    path = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").coalesce(1).write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").coalesce(1).write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, seen = docs.columns, [sorted((r.asDict() for r in docs.collect()), key=str)]
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = shared.stored(stage(spark, docs, folder), name)
        kept[name] = docs
        if name != "tokens":
            assert docs.columns == columns
            seen.append(sorted((r.asDict() for r in docs.collect()), key=str))
    before, clean, single, fresh, mixed = seen
    bad = {r["doc_id"] for r in before if r["text"] and {"vile", "scum", "trash"} & set(r["text"].split())}
    left = {r["doc_id"] for r in clean}
    assert len(bad & left) <= len(bad) * 0.05 and len([r for r in before if r["doc_id"] not in bad | left]) <= 10
    texts = {r["doc_id"]: r["text"] for r in clean if r["doc_id"] is not None}
    firsts = {d for d, g in brute_groups(texts, 5, 80).items() if g[2]}
    assert sorted(r["doc_id"] for r in single if r["doc_id"] is not None) == sorted(firsts)
    assert sum(r["doc_id"] is None for r in single) == 1
    hits = brute_hits({r["doc_id"]: r["text"] for r in single}, [(1, spark.read.parquet(f"{folder}/benchmark.parquet").first()["text"])])
    assert {r["doc_id"] for r in fresh} == {d for d, h in hits.items() if not h[3]}
    assert {r["doc_id"] for r in mixed} <= {r["doc_id"] for r in fresh} and abs(len(mixed) - len(fresh)) < 0.25 * len(fresh)
    tokens = kept["tokens"].orderBy("start").collect()
    assert [r["doc_id"] for r in tokens if r["doc_id"] is not None] == sorted(r["doc_id"] for r in mixed if r["doc_id"] is not None)
    total = 0
    for r in tokens:
        assert r["start"] == total
        total += r["n_tokens"]


def test_registered():
    import __spark_entry__

    names = set(__spark_entry__.queries())
    assert {"pipeline", *(n for n in names if n.startswith("op"))} <= names and sum(n.startswith("op") and n[2].isdigit() for n in names) == 13
    assert set(__spark_entry__.oracle_sql()) <= names


def test_run(spark, folder):
    out = corpus_pipeline.run(spark, folder)
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and out.where(F.col("n_tokens") < 1).isEmpty()


def test_near_dedup_without_ids(spark):
    text = " ".join(f"word{i}" for i in range(60))
    other = " ".join(f"other{i}" for i in range(60))
    rows = [(None, text, "a"), (None, text, "b"), (7, text + " tail", "c"), (None, other, "d"), (None, other, "e"), (None, other + " tail", "f"), (None, None, "g"), (None, " ", "h"), (None, " ", "i"), (8, "", "j"), (None, "alone in the world of all these many texts", "k")]
    got = corpus_pipeline.near_dedup(spark, spark.createDataFrame(rows, "doc_id long, text string, source string"), "").collect()
    assert sorted(r["source"] for r in got if r["source"] not in "def") == ["c", "g", "h", "i", "j", "k"]
    assert sum(r["source"] in "def" for r in got) == 1
    assert {r["doc_id"] for r in got} == {None, 7, 8}
