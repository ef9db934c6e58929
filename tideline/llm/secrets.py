"""Secret scanning with multipart credential linking, in DataFrame functions only.

Strong patterns are reported on their own. Weak candidates (an account name, a bare 40-character key, an endpoint) are
reported only when their complementary parts stand nearby: an interval join links every weak candidate with the parts
whose scope, `reach` code points around them, holds its start.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.shared import row_name, stored

#: kind: (order, role, pattern, least length, group whose length counts). Fixed values.
STRONG = {
    "assign": (0, "secret", "((?i)password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 6, 2),
    "access": (1, "identifier", "AKIA[A-Z0-9]+", 20, 0),
    "hex": (2, "secret", "(?<![0-9a-f])[0-9a-f]{24,}", 24, 0),
}
WEAK = {
    "account": (3, "identifier", "(?i)\\b(?:client_?id|access_?key_?id|user_?name|login)[\"']?\\x20*[:=]\\x20*[\"']?[a-z0-9_.@-]{3,}", 1, 0),
    "key": (4, "secret", "(?<![A-Za-z0-9/+=_-])(?![0-9a-f]{40})[A-Za-z0-9/+]{40}(?![A-Za-z0-9/+=_-])", 40, 0),
    "endpoint": (5, "endpoint", "(?i)\\b(?:https?|jdbc:[a-z]+|postgres|mysql|redis|amqp)://[a-z0-9.-]+(?::[0-9]+)?[a-z0-9/_.-]*", 1, 0),
}
#: What has to stand near a weak candidate.
NEEDS = {"account": ["secret"], "key": ["identifier"], "endpoint": ["identifier", "secret"]}
KINDS = STRONG | WEAK


def _matches(text: Column, kind: str) -> Column:
    """(before, match, counts) of each match: the code points since the last match, in it, and in its counted group."""
    _, _, pattern, _, group = KINDS[kind]
    before = F.transform(F.split(text, pattern, -1), F.char_length)
    whole = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.char_length)
    counts = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), F.char_length) if group else whole
    zipped = F.arrays_zip(F.slice(before, F.lit(1), F.size(whole)).alias("before"), whole.alias("match"), counts.alias("counts"))
    return F.transform(zipped, lambda x: F.struct(F.lit(kind).alias("kind"), x["before"].alias("before"), x["match"].alias("match"), x["counts"].alias("counts")))


def _spans(texts: DataFrame, kinds: list[str]) -> DataFrame:
    """k1, k2, kind, start, end of all matches that are long enough."""
    none = F.array().cast("array<struct<kind:string,before:int,match:int,counts:int>>")
    some = reduce(lambda x, y: x | y, (F.col("text").rlike(KINDS[k][2]) for k in kinds))
    lists = [F.when(F.col("text").rlike(KINDS[k][2]), _matches(F.col("text"), k)).otherwise(none) for k in kinds]
    rows = texts.where(some).select("k1", "k2", F.posexplode(F.concat(*lists)).alias("i", "x")).select("k1", "k2", "i", "x.*")
    rows = rows.dropDuplicates(["k1", "k2", "i"])
    end = F.sum(F.col("before") + F.col("match")).over(Window.partitionBy("k1", "k2", "kind").orderBy("i"))
    least = F.create_map(*(F.lit(x) for k in kinds for x in (k, KINDS[k][3])))
    return rows.withColumn("end", end).where(F.col("counts") >= least[F.col("kind")]).select("k1", "k2", "kind", (F.col("end") - F.col("match")).alias("start"), "end")


def find_secrets(docs: DataFrame, reach: int = 200) -> DataFrame:
    """doc_id, spans for each row of docs: spans is an array of (start, rank, kind, end, linked), in order.

    Starts and ends count code points, the end exclusive; rank is the kind's place in KINDS. Strong kinds are always
    there; weak ones (linked is true) where every part they need (NEEDS) has them within `reach` code points. A null
    text is empty and has no spans; repeated rows each have their own result; other columns are left out.
    """
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).select("doc_id", "text", *row_name())
    strong = stored(_spans(texts, list(STRONG)), "strong")
    #: No weak candidate counts without an identifier in its text.
    named = texts.where(F.col("text").rlike(KINDS["access"][2]) | F.col("text").rlike(KINDS["account"][2]))
    weak = stored(_spans(named, list(WEAK)), "weak")

    role = F.create_map(*(F.lit(x) for k, v in KINDS.items() for x in (k, v[1])))
    parts = strong.unionByName(weak).withColumn("role", role[F.col("kind")])
    cell = lambda x: F.floor(x / reach)
    scopes = parts.where("role != 'endpoint'").select("k1", "k2", "role", F.col("start").alias("s"), F.col("end").alias("e"), F.explode(F.sequence(cell(F.col("start") - reach), cell(F.col("end") + reach))).alias("cell"))
    asked = weak.withColumn("cell", cell(F.col("start")))
    inside = (F.col("start") >= F.col("s") - reach) & (F.col("start") <= F.col("e") + reach)
    met = asked.join(scopes, ["k1", "k2", "cell"]).where(inside).groupBy("k1", "k2", "kind", "start", "end").agg(F.max(F.col("role") == "identifier").alias("identifier"), F.max(F.col("role") == "secret").alias("secret"))
    needs = reduce(lambda x, y: x | y, ((F.col("kind") == k) & reduce(lambda a, b: a & b, (F.col(r) for r in v)) for k, v in NEEDS.items()))
    linked = met.where(needs).select("k1", "k2", "kind", "start", "end", F.lit(True).alias("linked"))

    rank = F.create_map(*(F.lit(x) for k, v in KINDS.items() for x in (k, v[0])))
    all_spans = strong.withColumn("linked", F.lit(False)).unionByName(linked)
    lists = all_spans.groupBy("k1", "k2").agg(F.array_sort(F.collect_list(F.struct("start", rank[F.col("kind")].alias("rank"), "kind", "end", "linked"))).alias("spans"))
    rows = texts.select("k1", "k2", "doc_id")
    return rows.join(stored(lists, "spans"), ["k1", "k2"], "left").select("doc_id", F.coalesce("spans", F.array().cast("array<struct<start:bigint,rank:int,kind:string,end:bigint,linked:boolean>>")).alias("spans"))
