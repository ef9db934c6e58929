"""Binary fields: varints, tagged fields, raw Snappy blocks, float bits. Vectorised UDFs."""

from __future__ import annotations

import struct

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MOST_BYTES, MOST_FIELDS = 4 << 20, 100_000
FIELDS = T.ArrayType(T.StructType().add("field", T.IntegerType()).add("wire", T.IntegerType()).add("number", T.DecimalType(20, 0)).add("raw", T.BinaryType()))


#: Why a value has no fields.
REASONS = ("no value", "too long", "a varint does not end", "a varint is over 64 bits", "field 0", "too many fields", "a field is cut off", "an unknown wire type")
NO_VALUE, TOO_LONG, OPEN, WIDE, ZERO, MANY, CUT, KIND = REASONS


class WireError(ValueError):
    """Says one of REASONS, or what is wrong with a number or block."""


def varint(data: bytes, at: int) -> tuple[int, int]:
    """The unsigned 64-bit number at `at`, and the place behind it."""
    out = shift = 0
    while True:
        if at >= len(data) or shift > 63:
            raise WireError(OPEN)
        byte = data[at]
        out |= (byte & 127) << shift
        at, shift = at + 1, shift + 7
        if byte < 128:
            if out >> 64:
                raise WireError(WIDE)
            return out, at


def varint_hex(v: Column) -> Column:
    """The varint of a long as hexadecimal digits; a negative number has ten bytes."""
    digits = F.lit("")
    for i in range(10):
        part = F.shiftrightunsigned(v, 7 * i)
        more = F.shiftrightunsigned(v, 7 * i + 7) != 0 if i < 9 else F.lit(False)
        byte = part.bitwiseAND(F.lit(127)).bitwiseOR(F.when(more, 128).otherwise(0).cast("long"))
        digits = F.concat(digits, F.when((part != 0) | F.lit(i == 0), F.lpad(F.hex(byte), 2, "0")).otherwise(""))
    return digits


def uint32(data: Column) -> Column:
    """The unsigned 32-bit number of the varint with which data begins; null where it doesn't end in five bytes, or is
    larger."""
    out, open_ = F.lit(0).cast("long"), F.lit(True)
    for i in range(5):
        byte = F.conv(F.hex(F.substring(data, i + 1, 1)), 16, 10).cast("long")
        out = F.when(open_, out + F.shiftleft(byte.bitwiseAND(F.lit(127)), 7 * i)).otherwise(out)
        open_ = open_ & (byte > 127)
    return F.when(~open_ & (out < 1 << 32), out)


def signed32(x: int) -> int:
    """A 32-bit number that was sign-extended to 64 bits; anything else is an error."""
    value = x - (1 << 64) if x >> 63 else x
    if not -(1 << 31) <= value < 1 << 31:
        raise WireError("not a 32-bit number")
    return value


def fields(data: bytes) -> list[tuple[int, int, int | None, bytes | None]]:
    """(field, wire type, number, bytes) of each field in order; repeats are kept."""
    if len(data) > MOST_BYTES:
        raise WireError(TOO_LONG)
    out, at = [], 0
    while at < len(data):
        tag, at = varint(data, at)
        kind, number, raw = tag & 7, None, None
        if not tag >> 3 or len(out) >= MOST_FIELDS:
            raise WireError(MANY if tag >> 3 else ZERO)
        if kind == 0:
            number, at = varint(data, at)
        elif kind in (1, 5, 2):
            size, at = (8, at) if kind == 1 else (4, at) if kind == 5 else varint(data, at)
            raw, at = data[at : at + size], at + size
            if len(raw) != size:
                raise WireError(CUT)
        else:
            raise WireError(KIND)
        out.append((tag >> 3, kind, number, raw))
    return out


def snappy_raw(data: bytes) -> bytes:
    """One raw Snappy block."""
    size, at = varint(data, 0)
    if size > MOST_BYTES:
        raise WireError("too long")
    out = bytearray()
    while at < len(data):
        tag, at = data[at], at + 1
        if tag & 3 == 0:
            n = tag >> 2
            if n >= 60:
                extra = n - 59
                n, at = int.from_bytes(data[at : at + extra], "little"), at + extra
            out += data[at : at + n + 1]
            at += n + 1
        else:
            kind = tag & 3
            n = (tag >> 2 & 7) + 4 if kind == 1 else (tag >> 2) + 1
            wide = (1, 2, 4)[kind - 1]
            back = int.from_bytes(data[at : at + wide], "little") | ((tag >> 5 << 8) if kind == 1 else 0)
            at += wide
            if not 0 < back <= len(out):
                raise WireError("a copy from before the start")
            for _ in range(n):
                out.append(out[-back])
    if len(out) != size:
        raise WireError("the size differs")
    return bytes(out)


def _tried(f, data):
    try:
        return f(bytes(data))
    except (WireError, IndexError, struct.error):
        return None


def _rows(got: list) -> list[dict]:
    from decimal import Decimal

    return [{"field": f, "wire": w, "number": None if n is None else Decimal(n), "raw": r} for f, w, n, r in got]


@F.pandas_udf(FIELDS)
def decode_fields(data: pd.Series) -> pd.Series:
    """Tagged fields of each value; null where it is null or malformed."""

    def one(x):
        got = None if x is None else _tried(fields, x)
        return None if got is None else _rows(got)

    return data.map(one)


@F.pandas_udf(T.StructType().add("fields", FIELDS).add("reason", T.StringType()))
def decoded(data: pd.Series) -> pd.DataFrame:
    """fields and reason: of the two the one that a value has. A null value has the reason "no value"; for the others see
    REASONS."""

    def one(x):
        if x is None:
            return None, NO_VALUE
        try:
            return _rows(fields(bytes(x))), None
        except WireError as e:
            return None, str(e)

    return pd.DataFrame([one(x) for x in data], columns=["fields", "reason"], dtype=object)


@F.pandas_udf(T.BinaryType())
def uncompress(data: pd.Series) -> pd.Series:
    """Raw Snappy blocks; null where a block is null or malformed."""
    return data.map(lambda x: None if x is None else _tried(snappy_raw, x))


@F.pandas_udf(T.LongType())
def _bits(x: pd.Series) -> pd.Series:
    return pd.Series(x.to_numpy(np.float64, na_value=np.nan).view(np.int64))


#: The bits of the one NaN that is kept; there are many.
NAN_BITS = 0x7FF8 << 48


def double_bits(x: Column | str) -> Column:
    """The 64 bits of a double, so that 0.0 and -0.0 differ; all NaNs are one, and null is null."""
    x = F.col(x) if isinstance(x, str) else x
    return F.when(x.isNotNull(), F.when(F.isnan(x), F.lit(NAN_BITS)).otherwise(_bits(x)))


@F.pandas_udf(T.DoubleType())
def half_ulp(x: pd.Series) -> pd.Series:
    """Half the distance from |x| to the next larger single-precision number."""
    v = np.abs(x.to_numpy(np.float64, na_value=np.nan)).astype(np.float32)
    return pd.Series((np.nextafter(v, np.float32(np.inf)).astype(np.float64) - v) / 2)
