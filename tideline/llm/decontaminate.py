"""Benchmark decontamination by winnowing, in DataFrame functions only.

A run of `window` words holds window - gram + 1 grams; its fingerprint is their least hash. Any run of `window` words
that a document shares with an item has one fingerprint in both, so keeping only the distinct fingerprints of each text
loses none. They are joined; a hit is then extended to the runs it stands for, which are compared word by word.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.shared import lower_ascii, row_name, stored

GAP = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
#: A side of a join is broadcast if its measured size is at most this; a larger one is joined by shuffles.
BROADCAST_BYTES = 4 << 20
#: Words of a contaminated text whose runs are looked up at once.
PIECE_WORDS = 4096


def words_of(text: Column) -> Column:
    text = F.coalesce(text.cast("string"), F.lit(""))
    lower = F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(lower_ascii(text))
    return F.array_remove(F.split(lower, GAP), "")


def _places(words: str, k: int) -> Column:
    """First places (from 1) of runs of k words."""
    n = F.size(words) - (k - 1)
    return F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))


def _of_next(values: str, i: Column, k: int) -> list[Column]:
    """The k values from place i (from 1) on."""
    return [F.get(values, i + (j - 1)) for j in range(k)]


def _hashed(texts: DataFrame) -> DataFrame:
    """texts with `hashed`: each word is hashed once, and runs of words are hashed by those numbers."""
    return texts.withColumn("hashed", F.transform("words", lambda w: F.xxhash64(w)))


def _prints(texts: DataFrame, window: int, gram: int, short: list[int]) -> DataFrame:
    """texts with `prints`: for each run of `window` words its fingerprint; and `n<k>`: the hash of each run of k words."""
    out = _hashed(texts)
    out = out.withColumn("grams", F.transform(_places("hashed", gram), lambda i: F.xxhash64(*_of_next("hashed", i, gram))))
    least = (lambda c: F.least(*c)) if window > gram else (lambda c: c[0])
    out = out.withColumn("prints", F.transform(_places("grams", window - gram + 1), lambda i: least(_of_next("grams", i, window - gram + 1))))
    for k in short:
        out = out.withColumn(f"n{k}", F.transform(_places("hashed", k), _run_hash(k)))
    return out.drop("grams", "hashed")


def _run_hash(k: int) -> Callable[[Column], Column]:
    return lambda i: F.xxhash64(F.slice("hashed", i, k))


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10, gram: int = 5) -> DataFrame:
    """doc_id, n_words, n_hit, items, k1, k2, contaminated for each row of docs; k1 and k2 are row_name().

    A document word is hit when it lies in a run of `window` words that an item has too; an item of fewer words, but not
    none, counts as one run. items: the item_ids, as strings in order, whose runs occur. A null or empty text has no
    words and no hits; a null item_id is left out of items, though its runs hit; repeated rows each have their result; an
    empty benchmark hits nothing.
    """
    items = stored(benchmark.select(F.col("item_id").cast("string").alias("item_id"), words_of(F.col("text")).alias("words")), "items")
    short = sorted(r[0] for r in items.select(F.size("words").alias("n")).where(f"n > 0 and n < {window}").distinct().collect())
    small = (items.agg(F.sum(F.size("words") + F.octet_length(F.array_join("words", " ")))).first()[0] or 0) <= BROADCAST_BYTES
    near = F.broadcast if small else lambda x: x
    long = _prints(items.where(F.size("words") >= window), window, gram, [])
    runs = long.select("item_id", F.explode(F.arrays_zip(F.col("prints").alias("print"), F.transform(_places("words", window), lambda i: F.array_join(F.slice("words", i, window), " ")).alias("run"))).alias("x")).select("item_id", "x.print", "x.run")
    whole = _hashed(items.where((F.size("words") > 0) & (F.size("words") < window))).select("item_id", F.xxhash64("hashed").alias("print"), F.array_join("words", " ").alias("run"))
    runs = stored(runs.unionByName(whole).distinct(), "runs")

    name = row_name()
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    read = texts.select(*name, words_of(F.col("text")).alias("words"))
    all_prints = _prints(read, window, gram, short).select("k1", "k2", F.explode(F.array_distinct(F.concat("prints", *(f"n{k}" for k in short)))).alias("print"))
    hits = all_prints.join(near(runs.select("print").distinct()), "print").select("k1", "k2").distinct()
    hits = stored(hits.withColumn("met", F.lit(True)), "hits")

    again = texts.select(*name, "doc_id", words_of(F.col("text")).alias("words"))
    again = again.join(F.broadcast(hits) if 16 * hits.count() <= BROADCAST_BYTES else hits, ["k1", "k2"], "left")
    #: A long text is looked at piece by piece; each run of words begins in one piece and lies in it as a whole.
    whole = again.where("met").select("k1", "k2", "doc_id", F.size("words").alias("n_words"), "words")
    cut = whole.withColumn("from", F.explode(F.sequence(F.lit(0), F.greatest(F.col("n_words") - 1, F.lit(0)), F.lit(PIECE_WORDS))))
    cut = cut.withColumn("words", F.slice("words", F.col("from") + 1, PIECE_WORDS + window - 1))
    found = _prints(cut, window, gram, short)

    def runs_at(prints: str, k: int) -> Column:
        return F.transform(F.col(prints), lambda x, i: F.struct((F.col("from") + i + 1).cast("int").alias("at"), F.lit(k).alias("k"), x.alias("print"), F.array_join(F.slice("words", i + 1, k), " ").alias("run")))

    lists = [runs_at("prints", window), *(runs_at(f"n{k}", k) for k in short)]
    every = found.select("k1", "k2", "doc_id", "n_words", F.explode(F.concat(*lists)).alias("x")).select("k1", "k2", "doc_id", "n_words", "x.*")
    met = every.join(near(runs.select("print").distinct()), "print", "left_semi").drop("print")
    #: Each row also sends one entry of its own, which meets nothing: it carries n_words and counts repeated rows.
    own = whole.select("k1", "k2", "doc_id", "n_words", F.lit(0).alias("at"), F.lit(0).alias("k"), F.concat(F.lit("\u0001"), F.col("k1").cast("string")).alias("run"))
    #: A row for each run, with all items that hold it, so that a document's run meets one row however many those are.
    runs_of = near(runs.groupBy("run").agg(F.array_sort(F.collect_set("item_id")).alias("holders"), F.lit(True).alias("known")))
    matched = own.unionByName(met).join(runs_of, "run", "left")
    per_doc = matched.groupBy("k1", "k2", "doc_id").agg(
        F.first("n_words").cast("long").alias("n_words"),
        F.collect_set(F.when(F.col("known"), F.struct("at", "k"))).alias("at"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("holders")))).alias("items"),
        F.sum(F.when(F.col("at") == 0, 1).otherwise(0)).alias("copies"),
    )
    per_doc = per_doc.withColumn("n_hit", F.size(F.array_distinct(F.flatten(F.transform("at", lambda s: F.sequence(s["at"], s["at"] + s["k"] - 1))))).cast("long"))
    dirty = per_doc.withColumn("_", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    clean = again.where("met is null").select("k1", "k2", "doc_id", F.size("words").cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_hit"), F.array().cast("array<string>").alias("items"))
    return clean.unionByName(dirty.select("k1", "k2", "doc_id", "n_words", "n_hit", "items")).withColumn("contaminated", F.col("n_hit") > 0)
