"""Button planes: three bit masks (was held at the end, changed, changed more than once) and their three-valued algebra."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def signed_plane(x: Column) -> Column:
    """An unsigned 64-bit number, as decimal(20,0), in a long's two's complement."""
    top = F.expr("9223372036854775808BD")
    return F.when(x >= top, x - F.expr("18446744073709551616BD")).otherwise(x).cast("long")


def any_bit(plane: Column, mask: int) -> Column:
    return plane.bitwiseAND(F.lit(mask)) != 0


def single_bit(mask: Column) -> Column:
    return F.bit_count(mask) == 1


def decode(p1: Column, p2: Column, p3: Column, mask: int) -> dict[str, Column]:
    """What the three planes say of one button; null where a plane is null."""
    held, changed, again = (any_bit(p, mask) for p in (p1, p2, p3))
    as_int = lambda c: c.cast("int")
    return {
        "code": as_int(held) + 2 * as_int(changed) + 4 * as_int(again),
        "held_end": held,
        "held_start": held != changed,
        "net_changed": changed,
        "pressed": held & changed,
        "released": ~held & changed,
        "activity": changed | again,
        "rapid": again,
    }


def any_true(*cells: Column) -> Column:
    """True if any cell is true, false if all are known to be false, else null."""
    return reduce(lambda a, b: a | b, cells)


def verdict(n: Column, failed: Column, passed: Column) -> Column:
    """failed if any failed; passed if there are rows and all passed; else unknown."""
    return F.when(failed > 0, "failed").when((n > 0) & (passed == n), "passed").otherwise("unknown")
