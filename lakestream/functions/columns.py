"""Scalar column expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# timestamp_millis raises beyond these, and one corrupt payload must not fail a whole job.
_MAX_EPOCH_MS = 9_223_372_036_854_775
# Years 1 to 9999, the range an ISO-8601 string can express.
_ISO_FIRST_MS = -62_135_596_800_000
_ISO_LAST_MS = 253_402_300_799_999


def utf8(column: Column | str) -> Column:
    """Bytes as text; null stays null."""
    return F.col(column).cast("string") if isinstance(column, str) else column.cast("string")


def epoch_ms_to_timestamp(ms: Column) -> Column:
    """Epoch milliseconds as a timestamp, null where the value is beyond what a timestamp holds."""
    return F.when(ms.between(-_MAX_EPOCH_MS, _MAX_EPOCH_MS), F.timestamp_millis(ms))


def epoch_ms_to_iso(ms: Column) -> Column:
    """Epoch milliseconds as ISO-8601 UTC text: six fraction digits, or none for a whole second."""
    moment = F.timestamp_millis(ms)
    pattern = "yyyy-MM-dd'T'HH:mm:ss"
    text = F.when(ms % 1000 == 0, F.date_format(moment, pattern + "'+00:00'")).otherwise(
        F.date_format(moment, pattern + ".SSSSSS'+00:00'")
    )
    return F.when(ms.between(_ISO_FIRST_MS, _ISO_LAST_MS), text)


def round_half_up(column: Column, digits: int) -> Column:
    """Round, after settling the value to 9 places.

    A distributed average adds up in no fixed order, so 12.3455 may come out as 12.345499999999999
    in one run and not in the next. Settling first makes such a tie round the same way every time.
    """
    return F.round(F.round(column, 9), digits)


def percentage(part: Column, whole: Column, digits: int = 2) -> Column:
    """100 * part / whole as a double; null for an empty group, where plain division would raise."""
    return round_half_up(F.try_divide(part.cast("double") * F.lit(100.0), whole.cast("double")), digits)


def date_string(year: Column, month: Column, day: Column) -> Column:
    return F.date_format(F.make_date(year, month, day), "yyyy-MM-dd")


_PARTS = {"year": F.year, "month": F.month, "day": F.dayofmonth, "hour": F.hour}


def with_date_parts(df: DataFrame, ts: str, grain: str = "day") -> DataFrame:
    """Add integer year, month, day and, at hour grain, hour columns taken from `ts`."""
    names = list(_PARTS)
    keep = names[: names.index(grain) + 1]
    return df.withColumns({name: _PARTS[name](F.col(ts)) for name in keep})


def human_bytes(size: Column) -> Column:
    """A byte count with one decimal in steps of 1024: 1536 -> '1.5 KB'."""
    units = ["B", "KB", "MB", "GB", "TB"]
    text = None
    for power, unit in enumerate(units):
        # n / 1024^k is exact in binary, so rounding half to even here is C's "%.1f"
        scaled = F.bround(size.cast("double") / F.lit(float(1024**power)), 1)
        label = F.format_string(f"%.1f {unit}", scaled)
        if text is None:
            text = F.when(size < 1024, label)
        elif unit == units[-1]:
            text = text.otherwise(label)
        else:
            text = text.when(size < 1024 ** (power + 1), label)
    return F.when(size.isNotNull(), text)


#: Stands between joined names; no name may hold it.
_BETWEEN = "\x1f"


def names_where(checks: Mapping[str, Column]) -> Column:
    """The names whose condition holds, in order, as a list. Joined and split again because that stays
    inside generated code, which array functions with a lambda would leave."""
    if any(_BETWEEN in name or not name for name in checks):
        raise ValueError("a name must not be empty or hold the unit separator")
    joined = F.concat_ws(_BETWEEN, *[F.when(check, name) for name, check in checks.items()])
    return F.when(joined == "", F.array().cast("array<string>")).otherwise(F.split(joined, _BETWEEN))


def celsius_to_fahrenheit(df: DataFrame, value: str = "value", unit: str = "unit") -> DataFrame:
    """Convert the rows measured in C, leave the others alone."""
    is_celsius = F.col(unit) == "C"
    return df.withColumns(
        {
            value: F.when(is_celsius, F.col(value) * 1.8 + 32.0).otherwise(F.col(value)),
            unit: F.when(is_celsius, F.lit("F")).otherwise(F.col(unit)),
        }
    )
