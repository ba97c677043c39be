"""Column expressions for the legacy encodings the schemas declare.

All are built-in Catalyst expressions, so they stay inside whole-stage
codegen. Formats the reference does not state are our choice and are
named here once.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Formats of the legacy encodings.
# date_key and week_start_key: integer yyyyMMdd; period_month: 'yyyy-MM';
# string day columns: 'yyyy-MM-dd'; Oracle strings: 'yyyyMMddHHmmss'.
DATE_KEY_FORMAT = "yyyyMMdd"
MONTH_FORMAT = "yyyy-MM"
DAY_FORMAT = "yyyy-MM-dd"
ORACLE_TS_FORMAT = "yyyyMMddHHmmss"

# Type of every bare NUMERIC column (scale 9).
NUMERIC = T.DecimalType(38, 9)


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_instant(c: str | Column) -> Column:
    """TIMESTAMP_NTZ (how the test Parquet reads) → TIMESTAMP in the session zone (UTC)."""
    return col(c).cast("timestamp")


def epoch_seconds(c: str | Column) -> Column:
    return F.unix_seconds(as_instant(c))


def epoch_millis(c: str | Column) -> Column:
    """Milliseconds since epoch, floored."""
    return F.unix_millis(as_instant(c))


def decode_epoch_seconds(c: str | Column) -> Column:
    return F.timestamp_seconds(col(c))


def decode_epoch_millis(c: str | Column) -> Column:
    return F.timestamp_millis(col(c))


def decode_misnamed_epoch(c: str | Column) -> Column:
    """A column named ``*_sec`` that holds milliseconds."""
    return F.timestamp_millis(col(c))


def encode_oracle_string(c: str | Column) -> Column:
    return F.date_format(col(c), ORACLE_TS_FORMAT)


def decode_oracle_string(c: str | Column) -> Column:
    """'YYYYMMDDHH24MISS' text → TIMESTAMP; junk or empty text → NULL."""
    return F.try_to_timestamp(col(c), F.lit(ORACLE_TS_FORMAT)).cast("timestamp")


def encode_date_key(c: str | Column) -> Column:
    return F.date_format(col(c), DATE_KEY_FORMAT).cast("bigint")


def decode_date_key(c: str | Column) -> Column:
    """INT yyyyMMdd → DATE."""
    return F.to_date(col(c).cast("string"), DATE_KEY_FORMAT)


def encode_month(c: str | Column) -> Column:
    return F.date_format(col(c), MONTH_FORMAT)


def decode_month(c: str | Column) -> Column:
    """'yyyy-MM' → DATE, first of the month."""
    return F.to_date(col(c), MONTH_FORMAT)


def decode_day(c: str | Column) -> Column:
    return F.to_date(col(c), DAY_FORMAT)


def iso_week_start(c: str | Column) -> Column:
    """DATE_TRUNC(d, ISOWEEK): the Monday on or before, as DATE."""
    return F.trunc(col(c), "week")


def month_start(c: str | Column) -> Column:
    return F.trunc(col(c), "month")


def hour_of_day(c: str | Column) -> Column:
    """EXTRACT(HOUR FROM ts) as INT64 (UTC session)."""
    return F.hour(col(c)).cast("bigint")


def cents(c: str | Column) -> Column:
    """Two-decimal money as integer cents, so sums are exact."""
    return F.round(col(c) * 100).cast("bigint")


def zero_numeric() -> Column:
    return F.lit(0).cast(NUMERIC)


def exact_mean(total: Column, count: Column) -> Column:
    """AVG(CAST(x AS NUMERIC)) from a sum and a count: one HALF_UP rounding at scale 9."""
    return (total.cast(NUMERIC) / count.cast("decimal(20,0)")).cast(NUMERIC)


def safe_ratio_numeric(num: Column, den: Column) -> Column:
    """CAST(SAFE_DIVIDE(num, NULLIF(den, 0)) AS NUMERIC): FLOAT64 division, then NUMERIC."""
    return F.try_divide(num.cast("double"), F.nullif(den, F.lit(0)).cast("double")).cast(NUMERIC)


def exact_ratio(num: Column, den: Column, scale: int = 2, precision: int = 5) -> Column:
    """num / den (non-negative integers), rounded HALF_UP at ``scale``, as DECIMAL(precision, scale); NULL when den is 0.

    Integer division of doubled operands, so the rounding is exact for any denominator.
    """
    whole = T.DecimalType(38, 0)
    n, d = num.cast(whole), F.nullif(den, F.lit(0)).cast(whole)
    units = F.call_function("div", n * F.lit(2 * 10 ** scale).cast("decimal(9,0)") + d, d * F.lit(2).cast("decimal(1,0)"))
    return (units.cast("decimal(20,0)") * F.lit(10 ** -scale).cast(T.DecimalType(scale + 1, scale))).cast(
        T.DecimalType(precision, scale))
