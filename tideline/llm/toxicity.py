"""Toxicity: a linear classifier on words, regularised by counterfactuals.

For every training sentence that names a group, the sentence with the group's name swapped is scored too, and the squared
difference of the two logits is a penalty. Names of groups so lose the weight that they owe to the company they keep.

Few texts are toxic, so the plain probability is far too low to decide by. Two halves of the training rows score each
other; the logit that parts those best (by F1) is moved to the logit of the score from which a text counts as toxic.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.shared import Words, mix, pieces, stored

SEED = 0x70C1
#: Letters and everything beyond ASCII make words.
TABLE = np.zeros(256, bool)
TABLE[[*range(0x61, 0x7B), *range(0x80, 0x100)]] = True
#: Words for groups of people; each list's members are swapped for each other. Fixed values.
GROUPS = (
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "arab"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("immigrant", "native", "refugee", "foreigner"),
    ("immigrants", "natives", "refugees", "foreigners"),
    ("old", "young", "disabled", "blind", "deaf"),
    ("frauen", "männer"),
    ("femmes", "hommes"),
    ("mujeres", "hombres"),
)


@dataclass
class Model:
    """Sorted hashes of the words it knows, their weights, and the bias."""

    words: np.ndarray
    weights: np.ndarray
    bias: float

    def scores(self, words: Words) -> np.ndarray:
        """The probability of each text, from which words it has."""
        out = np.full(len(words.n), self.bias)
        if len(self.words):
            h = words.hashes(SEED)
            at = np.minimum(np.searchsorted(self.words, h), len(self.words) - 1)
            some = np.flatnonzero(self.words[at] == h)
            pair = np.unique(words.doc[some] * len(self.words) + at[some])
            np.add.at(out, pair // len(self.words), self.weights[pair % len(self.words)])
        return 1 / (1 + np.exp(-np.clip(out, -60, 60)))


def _hashes(terms: list[str]) -> np.ndarray:
    return Words(pa.array(terms, pa.string()), table=TABLE).hashes(SEED)


def training_rows(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """doc_id, text, toxic of at most `most` labelled documents, drawn by a hash of the id, with labels by training ids.
    Of rows that repeat an id the one with the least text counts, so that there are no more rows than ids."""
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    drawn = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(drawn), "doc_id")
    return rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("toxic").alias("toxic"))


def fit(docs: DataFrame, labels: DataFrame, most_rows: int = 30_000, most_words: int = 4096, least_docs: int = 3, strength: float = 1e-4, fairness: float = 1.0, steps: int = 400, toxic_at: float = 0.7) -> Model:
    """A model from at most `most_rows` of the labelled documents and their `most_words` most telling words (chi-squared
    of having the word, in at least `least_docs` of them). Labels of 1 are toxic; null labels and ids teach nothing, nor do
    labels without a document; of several labels of one id the largest counts. A score of `toxic_at` is where toxic and
    other texts part best. Without labels of both kinds (an empty table, say) the model knows no words and its bias says
    the share of toxic ones; without them in both halves of the rows the scores are plain probabilities."""
    rows = stored(training_rows(docs, labels, most_rows), "labelled")
    n, n_toxic = rows.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    bias = float(np.log((n_toxic + 0.5) / (n - n_toxic + 0.5)))
    if not n_toxic or n_toxic == n:
        return Model(np.zeros(0, np.uint64), np.zeros(0), bias)

    def count(batches):
        for batch in batches:
            for part in pieces(batch, "text"):
                words = Words(part.column("text"), lower=True, table=TABLE)
                pair = np.unique(np.stack([words.doc.astype(np.uint64), words.hashes(SEED)], 1), axis=0) if len(words.doc) else np.zeros((0, 2), np.uint64)
                toxic = part.column("toxic").to_numpy(zero_copy_only=False)[pair[:, 0].astype(np.int64)]
                h, at = np.unique(pair[:, 1], return_inverse=True)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(np.bincount(at, minlength=len(h)), pa.int64()), pa.array(np.bincount(at, toxic, len(h)).astype(np.int64))], ["word", "n", "t"])

    seen = rows.mapInArrow(count, "word long, n long, t long").groupBy("word").agg(F.sum("n").alias("n"), F.sum("t").alias("t"))
    a, b, c, d = F.col("t"), F.col("n") - F.col("t"), F.lit(n_toxic) - F.col("t"), F.lit(n - n_toxic) - F.col("n") + F.col("t")
    chi = F.lit(float(n)) * F.pow(a * d - b * c, F.lit(2.0)) / ((a + b) * (c + d) * F.lit(float(n_toxic)) * F.lit(float(n - n_toxic)) + 1e-9)
    telling = seen.where(F.col("n") >= least_docs).withColumn("chi", chi).where("chi > 15").orderBy(F.desc("chi"), "word").limit(most_words)
    chosen = np.array([r["word"] for r in telling.select("word").collect()], np.int64).view(np.uint64)
    groups = [_hashes(list(g)) for g in GROUPS]
    vocabulary = np.unique(np.concatenate([chosen, *groups]))
    swap = np.full(len(vocabulary), -1)
    for g in groups:
        at = np.searchsorted(vocabulary, g)
        swap[at] = np.roll(at, -1)

    def have(batches):
        for batch in batches:
            for part in pieces(batch, "text"):
                words = Words(part.column("text"), lower=True, table=TABLE)
                h = words.hashes(SEED)
                at = np.minimum(np.searchsorted(vocabulary, h), len(vocabulary) - 1)
                some = vocabulary[at] == h
                pair = np.unique(words.doc[some] * len(vocabulary) + at[some])
                cut = np.searchsorted(pair // len(vocabulary), np.arange(part.num_rows + 1))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("toxic"), pa.array([(pair[x:y] % len(vocabulary)).astype(np.int32).tobytes() for x, y in zip(cut, cut[1:], strict=False)], pa.binary())], ["doc_id", "toxic", "words"])

    #: At most most_rows rows of at most most_words words.
    table = rows.mapInArrow(have, "doc_id long, toxic int, words binary").orderBy("doc_id", "words").toArrow()
    sets = [np.frombuffer(x, np.int32) for x in table.column("words").to_pylist()]
    y = table.column("toxic").to_numpy().astype(float)
    half = (mix(table.column("doc_id").to_numpy().view(np.uint64).copy()) >> np.uint64(63)).astype(bool)
    train = lambda some: descend([s for s, own in zip(sets, some, strict=True) if own], y[some], swap, len(vocabulary), bias, strength, fairness, steps)
    shift = 0.0
    if all(0 < y[some].sum() < some.sum() for some in (half, ~half)):
        logits = np.zeros(len(y))
        for some in (half, ~half):
            w, b = train(some)
            logits[~some] = [w[s].sum() + b for s, own in zip(sets, ~some, strict=True) if own]
        shift = np.log(toxic_at / (1 - toxic_at)) - parting(logits, y)
    weights, bias = train(np.ones(len(y), bool))
    keep = weights != 0
    return Model(vocabulary[keep], weights[keep], float(bias + shift))


def parting(logits: np.ndarray, y: np.ndarray) -> float:
    """The value half way between those neighbouring logits between which a threshold has the largest F1."""
    order = np.argsort(-logits, kind="stable")
    ordered, hits = logits[order], np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(y) + 1) + y.sum())
    f1[:-1][ordered[:-1] == ordered[1:]] = -1
    at = int(np.argmax(f1))
    return float((ordered[at] + ordered[at + 1]) / 2 if at + 1 < len(y) else ordered[at] - 1)


def descend(sets: list[np.ndarray], y: np.ndarray, swap: np.ndarray, width: int, bias: float, strength: float, fairness: float, steps: int) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise log loss + strength * |w|^2 / 2 + fairness * mean((score - swapped score)^2)."""
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    col = np.concatenate(sets) if sets else np.zeros(0, np.int32)
    named = swap[col] >= 0
    # The swapped sentence has the other name where it had the one; the difference of both scores has these entries.
    d_row, d_col = np.concatenate([row[named]] * 2), np.concatenate([col[named], swap[col[named]]])
    d_sign = np.repeat([1.0, -1.0], named.sum())
    n, n_named = max(1, len(sets)), max(1, len(np.unique(row[named])))
    w, m, v = np.zeros(width + 1), np.zeros(width + 1), np.zeros(width + 1)
    w[-1] = bias
    for k in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(row, w[col], len(sets)) + w[-1], -60, 60)))
        error = (p - y) / n
        g = np.append(np.bincount(col, error[row], width), error.sum())
        g[:-1] += strength * w[:-1]
        if len(d_row):
            apart = np.bincount(d_row, d_sign * w[d_col], len(sets))
            g[:-1] += np.bincount(d_col, 2 * fairness / n_named * d_sign * apart[d_row], width)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.1 * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.999**k)) + 1e-9)
    return w[:-1], float(w[-1])


def score_toxicity(docs: DataFrame, model: Model, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, score and the columns named in keep, for every row of docs, from its whole text alone. A null or empty
    text has the score of a text without known words; repeated rows are scored alike; empty tables stay empty; a null
    doc_id stays null. Columns that keep doesn't name are left out, whatever they are called; keep can't name `score`."""
    #: Plain arrays, so that executors can read them without the package.
    shared = docs.sparkSession.sparkContext.broadcast((model.words, model.weights, model.bias))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *(c for c in keep if c not in ("doc_id", "text")))

    def score(batches):
        model = Model(*shared.value)
        for batch in batches:
            for part in pieces(batch, "text"):
                got = model.scores(Words(part.column("text"), lower=True, table=TABLE))
                columns = [part.column("doc_id"), pa.array(got), *(part.column(c) for c in keep if c != "doc_id")]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "score", *(c for c in keep if c != "doc_id")])

    fields = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = ", ".join(f"`{c}` {k}" for c, k in [("doc_id", "bigint"), ("score", "double"), *((c, fields[c]) for c in keep if c != "doc_id")])
    return rows.mapInArrow(score, schema)


def train_fold(labels: DataFrame) -> DataFrame:
    """The labels that may be learnt from: crc32 of the id's text, modulo 3, is not 1."""
    return labels.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1)
