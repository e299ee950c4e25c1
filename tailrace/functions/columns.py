"""Scalar functions as Column expressions; everything here stays inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that results depend on.
TOPIC_PATTERN = r"[0-9a-zA-Z_\-]+"
OFFSET_NAME_PATTERN = r"[0-9a-f]+"
METRICS_TOPIC = "-metrics-"
ID_MULTIPLIER = 213887370601841

_U32 = 0xFFFFFFFF


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def full_match(value: Column | str, pattern: str) -> Column:
    """RLIKE finds anywhere; anchor the pattern so that the whole value must match."""
    return _col(value).rlike(rf"\A(?:{pattern})\z")


def java_string_hash(value: Column | str) -> Column:
    """31-polynomial over the UTF-16 code units with 32-bit wrap, as a signed INT."""
    value = _col(value)

    def step(acc: Column, cp: Column) -> Column:
        one = (acc * 31 + cp).bitwiseAND(F.lit(_U32))
        over = cp - 0x10000
        high = F.lit(0xD800) + F.shiftright(over, 10)
        low = F.lit(0xDC00) + over.bitwiseAND(F.lit(0x3FF))
        pair = ((acc * 31 + high) * 31 + low).bitwiseAND(F.lit(_U32))
        return F.when(cp < 0x10000, one).otherwise(pair)

    chars = F.filter(F.split(value, ""), lambda c: c != "")
    points = F.transform(chars, lambda c: F.ascii(c).cast("bigint"))
    return F.aggregate(
        points,
        F.lit(0).cast("bigint"),
        step,
        lambda h: F.when(h >= 1 << 31, h - (1 << 32)).otherwise(h).cast("int"),
    )


def floor_div(value: Column, divisor: Column | int) -> Column:
    """Exact integer floor division (``div`` alone truncates towards zero)."""
    divisor = F.lit(divisor) if isinstance(divisor, int) else divisor
    return F.call_function("div", value - F.pmod(value, divisor), divisor)


def message_id(client: Column | str, n: Column | str) -> Column:
    """``(client xor n * multiplier) >>> 1`` with the product wrapped to 64 bits.

    The product is taken in decimals, because 64-bit multiplication raises on overflow in ANSI mode.
    """
    two64 = F.lit(str(1 << 64)).cast("decimal(20,0)")
    two63 = F.lit(str(1 << 63)).cast("decimal(20,0)")
    product = _col(n).cast("decimal(19,0)") * F.lit(ID_MULTIPLIER).cast("decimal(15,0)")
    wrapped = F.pmod(product, two64)
    signed = F.when(wrapped >= two63, wrapped - two64).otherwise(wrapped).cast("bigint")
    return F.shiftrightunsigned(_col(client).cast("bigint").bitwiseXOR(signed), 1)


def offset_name(offset: Column | str) -> Column:
    """File name of an offset: 16 lower-case hex digits."""
    return F.lpad(F.lower(F.hex(_col(offset).cast("bigint"))), 16, "0")


def name_offset(name: Column | str) -> Column:
    """Offset of a file name; NULL for a name that is not a hex number in range."""
    name = _col(name)
    digits = F.when(full_match(name, OFFSET_NAME_PATTERN), F.conv(name, 16, 10))
    return digits.try_cast("bigint")


def stream_offset(base_offset: Column | str, record_offset: Column | str) -> Column:
    return _col(base_offset) + _col(record_offset)


def server_key(server_id: Column | str) -> Column:
    """Text by which server ids sort: unsigned, as 16 hex digits."""
    return offset_name(server_id)


def same_hosts(a: Column | str, b: Column | str) -> Column:
    """True when two host arrays hold the same set of addresses."""
    a, b = _col(a), _col(b)
    return (F.size(F.array_except(a, b)) == 0) & (F.size(F.array_except(b, a)) == 0)


def varint_size(value: Column) -> Column:
    """Bytes a base-128 varint takes; negative numbers take ten."""
    value = value.cast("bigint")
    size = F.when(value < 0, 10)
    for n in range(1, 9):
        size = size.when(value < (1 << (7 * n)), n)
    return size.otherwise(9)


def frame_size(time: Column | str | None, payload: Column | str, envelope: bool = True) -> Column:
    """Bytes one message takes on disk: 4-byte length and body; absent fields take no room."""
    length = F.octet_length(_col(payload))
    if not envelope:
        return (F.lit(4) + F.coalesce(length, F.lit(0))).cast("bigint")
    time_part = F.when(_col(time).isNull(), 0).otherwise(varint_size(_col(time)) + 1)
    payload_part = F.when(length.isNull(), 0).otherwise(varint_size(length) + 1 + length)
    return (F.lit(4) + time_part + payload_part).cast("bigint")
