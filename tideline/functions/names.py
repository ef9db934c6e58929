"""Identity strings, labels, digests and deterministic splits."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_sha256(x: Column) -> Column:
    return F.coalesce(x.rlike("^[0-9a-f]{64}$"), F.lit(False))


def numeric_identity(x: Column) -> Column:
    """A decimal id over 0 and under 2^64 as decimal(20,0), else null."""
    as_number = F.when(x.rlike("^[0-9]{1,20}$"), x).cast("decimal(38,0)")
    return F.when((as_number > 0) & (as_number < F.expr("18446744073709551616BD")), as_number).cast("decimal(20,0)")


def player_key(steam: Column, slot: Column) -> Column:
    return F.when(steam.isNotNull() & (steam != 0), F.concat(F.lit("steam:"), steam.cast("string"))).otherwise(F.concat(F.lit("slot:"), slot.cast("string")))


def clean_name(x: Column, most: int = 100) -> Column:
    return F.substring(F.trim(F.regexp_replace(x, "\\s+", " ")), 1, most)


def short_id(*parts: Column, size: int = 24) -> Column:
    return F.substring(F.sha2(F.concat_ws(":", *(p.cast("string") for p in parts)), 256), 1, size)


def bucket(seed: str, key: Column, buckets: int = 10_000) -> Column:
    """The sha256 of seed and key, as a number, modulo buckets: folded over its sixteen four-digit groups."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), key.cast("string")), 256)
    groups = F.transform(F.sequence(F.lit(0), F.lit(15)), lambda i: F.conv(F.substring(digest, i * 4 + 1, F.lit(4)), 16, 10).cast("long"))
    return F.aggregate(groups, F.lit(0).cast("long"), lambda a, x: (a * 65536 + x) % buckets)


def split_of(seed: str, key: Column) -> Column:
    """train, validation or test: 80, 10 and 10 of 100, the same for every row of a key."""
    b = bucket(seed, key)
    return F.when(b < 8000, "train").when(b < 9000, "validation").otherwise("test")


def parse_windows(text: Column) -> Column:
    """'a:b,c:d' as an array of (start, end); null where any part is no window with 0 <= start < end, or two overlap."""
    parts = F.transform(F.split(text, ","), lambda x: F.struct(F.split(x, ":")[0].try_cast("long").alias("start"), F.try_element_at(F.split(x, ":"), F.lit(2)).try_cast("long").alias("end")))
    ordered = F.array_sort(parts)
    fine = F.forall(ordered, lambda x: F.coalesce((x["start"] >= 0) & (x["start"] < x["end"]), F.lit(False)))
    meets = F.exists(F.transform(ordered, lambda x, i: F.coalesce((i > 0) & (F.get(ordered, i - 1)["end"] > x["start"]), F.lit(False))), lambda x: x)
    return F.when(fine & ~meets, ordered)


def canonical_json(*columns: str) -> Column:
    """Compact JSON with sorted keys and explicit nulls."""
    return F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"})
