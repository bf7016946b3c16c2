"""Column expressions shared by the transforms (O-58a..m, O-18, O-23..O-25, O-29).

All are built-in Spark expressions: they stay inside whole-stage codegen and
work the same on batch and streaming DataFrames. Time helpers work on
TIMESTAMP_NTZ so results do not depend on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..sources.dims import FACTORY_ID_PREFIX

def epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# -- time -------------------------------------------------------------------

def seconds_time(ms: str | Column) -> Column:
    """toDateTime(ms / 1000): whole seconds, as TIMESTAMP_NTZ (UTC wall clock)."""
    m = col(ms)
    return F.timestamp_add("MILLISECOND", m - F.pmod(m, F.lit(1000)), epoch())


def millis_time(ms: str | Column) -> Column:
    return F.timestamp_add("MILLISECOND", col(ms), epoch())


def hour_start(ms: str | Column) -> Column:
    """toStartOfHour(toDateTime(ms / 1000))."""
    return F.date_trunc("HOUR", seconds_time(ms)).cast("timestamp_ntz")


def year_month(ms: str | Column) -> Column:
    """toYYYYMM(toDateTime(ms / 1000)) as INT, the partition value of the event table."""
    t = millis_time(ms)
    return (F.year(t) * 100 + F.month(t)).cast("int")


def iso_millis(ms: str | Column) -> Column:
    """JavaScript ``new Date(ms).toISOString()``."""
    return F.date_format(millis_time(ms), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def epoch_millis_ntz(ts: str | Column) -> Column:
    """Milliseconds since the epoch of a TIMESTAMP_NTZ column (floors)."""
    return F.timestamp_diff("MILLISECOND", epoch(), col(ts))


# -- text -------------------------------------------------------------------

def signed_in(amount: str | Column) -> Column:
    """V3 swap: a non-negative signed amount is the input side ('0' otherwise)."""
    a = col(amount)
    return F.when(a.startswith("-"), F.lit("0")).otherwise(a)


def signed_out(amount: str | Column) -> Column:
    """V3 swap: a negative signed amount is the output side, digits after the sign."""
    a = col(amount)
    return F.when(a.startswith("-"), a.substr(F.lit(2), F.length(a))).otherwise(F.lit("0"))


def first_present(*cols: str | Column, default=None) -> Column:
    """First non-NULL of several source fields; only NULL counts as missing (0 and '' are kept)."""
    parts = [col(c) for c in cols]
    if default is not None:
        parts.append(default if isinstance(default, Column) else F.lit(default))
    return F.coalesce(*parts)


def or_empty(c: str | Column) -> Column:
    return F.coalesce(col(c).cast("string"), F.lit(""))


def lower_key(c: str | Column) -> Column:
    """Join key for addresses: case-insensitive on checksummed text."""
    return F.lower(col(c))


def pool_key(chain: str | Column, address: str | Column) -> Column:
    """Identity of a pool: the chain it lives on and its address (NULL without an address)."""
    return F.concat(col(chain).cast("string"), F.lit(":"), lower_key(address))


def surrogate_tx_hash(*cols: str | Column) -> Column:
    """Deterministic stand-in when a log has no transaction hash (replays dedupe)."""
    return F.concat(F.lit("tx-"), F.sha2(F.concat_ws("|", *[col(c).cast("string") for c in cols]), 256))


def event_id(tx: str | Column, log_index: str | Column, event_type: str | Column) -> Column:
    """``{tx}-{logIndex}-{type}``."""
    return F.concat_ws("-", col(tx), col(log_index).cast("string"), col(event_type))


def factory_event_id(tx: str | Column, log_index: str | Column, event_type: str | Column) -> Column:
    """``factory-{tx}-{logIndex}-{type}`` (deterministic, unlike a clock-based id)."""
    return F.concat_ws("-", F.lit(FACTORY_ID_PREFIX), col(tx), col(log_index).cast("string"), col(event_type))


def fee_tier_label(fee: str | Column) -> Column:
    """fee / 10000 printed as a JavaScript number plus '%': 500 -> 0.05%, 3000 -> 0.3%, 10000 -> 1%.

    Exact integer text arithmetic; no float rounding.
    """
    f = col(fee).cast("bigint")
    whole = ((F.abs(f) - F.abs(f) % 10000) / 10000).cast("bigint").cast("string")
    frac = F.regexp_replace(F.lpad((F.abs(f) % 10000).cast("string"), 4, "0"), "0+$", "")
    sign = F.when(f < 0, F.lit("-")).otherwise(F.lit(""))
    number = F.concat(sign, whole, F.when(frac == "", F.lit("")).otherwise(F.concat(F.lit("."), frac)))
    return F.when(f.isNull(), F.lit(None)).otherwise(F.concat(number, F.lit("%")))


def json_text(c: str | Column) -> Column:
    """Integers from the chain library are big integers and serialise as JSON strings."""
    return col(c).cast("string")
