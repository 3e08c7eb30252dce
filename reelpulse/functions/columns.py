"""Column expressions shared by the operators.

All of these are built-in Spark expressions, so they stay inside
whole-stage codegen; nothing here runs Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EVENT_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
HOUR_BUCKET_FORMAT = "yyyyMMddHH"

# Fixed values that must equal the reference's for right results.
AGE_GROUP_LABELS = ("Children", "Young Adults", "Middle-aged", "Senior")
NIGHT_START_HOUR, NIGHT_END_HOUR = 22, 4
WEEKEND_DAYS = (1, 7)  # dayofweek: 1 = Sunday, 7 = Saturday


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_time(text, fmt: str = EVENT_TIME_FORMAT) -> Column:
    """Text -> timestamp; unparsable text becomes null (ANSI-safe, trap T2)."""
    return F.try_to_timestamp(col(text), F.lit(fmt))


def hour_bucket(ts) -> Column:
    """Timestamp -> ``yyyyMMddHH`` partition key."""
    return F.date_format(col(ts), HOUR_BUCKET_FORMAT)


def blank_to_null(c) -> Column:
    return F.nullif(col(c), F.lit(""))


def is_blank(c) -> Column:
    c = col(c)
    return c.isNull() | (c == "")


def digits_int(c) -> Column:
    """Int only when the text is all digits (``"4.0"``, ``"-1"`` -> null)."""
    c = col(c)
    return F.when(c.rlike("^[0-9]+$"), c.try_cast("int"))


def number_or_default(c, default: float, typ: str = "double") -> Column:
    """Empty or missing -> default; otherwise the parsed number."""
    c = col(c)
    return F.when(is_blank(c), F.lit(default).cast(typ)).otherwise(c.try_cast(typ))


def capped_progress(watched, length) -> Column:
    """Watch progress in percent, rounded to 2 places, ceiling 100.

    A null or non-positive length gives 0.0; a null watch time stays null
    (``least`` would turn that null into 100 - trap T15).
    """
    pct = F.when(col(length) > 0, F.round(col(watched) / col(length) * 100, 2)).otherwise(F.lit(0.0))
    return F.when(pct > 100.0, F.lit(100.0)).otherwise(pct)


def age_group(age) -> Column:
    a = col(age)
    children, young, middle, senior = AGE_GROUP_LABELS
    return (
        F.when(a < 18, children)
        .when((a >= 18) & (a <= 35), young)
        .when((a >= 36) & (a <= 55), middle)
        .otherwise(senior)
    )


def is_night_hour(hour) -> Column:
    h = col(hour)
    return F.when((h >= NIGHT_START_HOUR) | (h <= NIGHT_END_HOUR), True).otherwise(False)


def is_weekend_day(dow) -> Column:
    return F.when(col(dow).isin(*WEEKEND_DAYS), True).otherwise(False)


def years_since(date_text, as_of, fmt: str = "yyyy-MM-dd") -> Column:
    """Whole-year difference of the calendar years; bad dates -> null."""
    born = F.try_to_timestamp(col(date_text).cast("string"), F.lit(fmt))
    return (F.year(col(as_of)) - F.year(born)).cast("int")


# Summation order moves the last bits of a double sum.  Reports round twice, so
# that a mean which lies on a rounding boundary always falls to the same side.
NOISE_DIGITS = 6


def rounded(c, digits: int = 2) -> Column:
    return F.round(F.round(col(c), NOISE_DIGITS), digits)
