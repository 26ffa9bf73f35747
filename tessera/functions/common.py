"""Small column helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def idiv(c: str | Column, n: int | Column) -> Column:
    """Integer division truncating toward zero (SQL ``a div b``), bigint."""
    return F.call_function("div", col(c), n if isinstance(n, Column) else F.lit(n))


def epoch_micros(df: DataFrame, c: str) -> Column:
    """Microseconds since 1970-01-01 of a timestamp column without passing a
    TIMESTAMP_NTZ through the session time zone (which would shift wall
    clocks inside DST gaps): NTZ -> wall-clock difference to the NTZ epoch;
    TIMESTAMP -> the instant's micros."""
    dt = df.schema[c].dataType
    if isinstance(dt, T.TimestampNTZType):
        return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{c}`)")
    return F.unix_micros(F.col(c).cast("timestamp"))


def wall_clock(c: str | Column) -> Column:
    """HH:MM:SS of a timestamp's own fields (no zone conversion for NTZ)."""
    t = col(c)
    return F.format_string("%02d:%02d:%02d", F.hour(t), F.minute(t), F.second(t))
