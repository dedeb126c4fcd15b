"""Column functions: parsing of untidy texts, price changes, RSI values, split and bonus ratios. All stay in the JVM."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Date formats tried in this order (fixed values); a one-letter day accepts one or two digits.
DATE_FORMATS = ("d-MMM-yy", "d-M-yyyy", "d/M/yyyy", "yyyy-MM-dd", "M/d/yyyy", "d-MMM-yyyy", "yyyyMMdd")


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def first_nonblank(*columns: Column) -> Column:
    """The first of ``columns`` that isn't null or blank, trimmed."""
    return F.coalesce(*[blank_to_null(c) for c in columns])


def named(df: DataFrame, *candidates: str) -> Column:
    """First non-blank of the columns with these names, whatever their case; null if there is none."""
    own = {c.strip().lower(): c for c in df.columns}
    found = [F.col(f"`{own[n.lower()]}`").cast("string") for n in candidates if n.lower() in own]
    return first_nonblank(*found) if found else F.lit(None).cast("string")


def _shape(fmt: str) -> str:
    """A pattern of all texts that a date format can fit: the others need no attempt, and a failed one costs an exception."""
    number = "[+-]?[0-9]+"
    part = {"d": number, "dd": number, "M": number, "MM": number, "MMM": "[^0-9]+", "MMMM": "[^0-9]+", "yy": "[0-9]{2}", "yyyy": "[+-]?[0-9]{4,}"}
    if "yyyyMMdd" in fmt:
        return "^[+-]?[0-9]+$"
    return "^" + re.sub("[A-Za-z]+", lambda m: part.get(m[0], ".+"), fmt) + "$"


def parse_date(c: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """The first format that fits wins. Two-digit years above 68 belong to the last century."""
    c = blank_to_null(c)
    tries = []
    for f in formats:
        d = F.when(c.rlike(_shape(f)), F.try_to_date(c, f))
        tries.append(F.when(F.year(d) > 2068, F.add_months(d, -1200)).otherwise(d) if f.endswith("-yy") else d)
    return F.coalesce(*tries)


def parse_decimal(c: Column, kind: str = "decimal(20,2)") -> Column:
    """Two decimals, half away from zero; null for what is no number."""
    return F.trim(c).try_cast(kind)


def parse_int(c: Column) -> Column:
    """Whole number, also of a text like ``3490.00``."""
    return F.trim(c).try_cast("double").try_cast("bigint")


def percent_change(close: Column, prev: Column) -> Column:
    return F.try_divide((close - prev) * 100, prev)


def gain(close: Column, prev: Column) -> Column:
    return F.when((close - prev).isNotNull(), F.greatest(close - prev, F.lit(0.0)))


def loss(close: Column, prev: Column) -> Column:
    return F.when((close - prev).isNotNull(), F.greatest(prev - close, F.lit(0.0)))


def rsi_value(avg_gain: Column, avg_loss: Column) -> Column:
    """Null without movement, 100 without losses, otherwise 100 - 100 / (1 + gain / loss) to two decimals."""
    return (
        F.when(avg_gain.isNull() | avg_loss.isNull() | ((avg_gain == 0) & (avg_loss == 0)), F.lit(None).cast("double"))
        .when(avg_loss == 0, F.lit(100.0))
        .otherwise(F.round(100 - F.lit(100.0) / (1 + avg_gain / F.nullif(avg_loss, F.lit(0.0))), 2))
    )


def classify_action(text: Column) -> Column:
    """BONUS, else SPLIT, else null (out of scope)."""
    t = F.lower(text)
    return F.when(t.contains("bonus"), "BONUS").when(t.rlike("split|sub-division|sub division|subdivision"), "SPLIT")


# The wordings that announcements use.
BONUS_PATTERN = r"(?i)bonus\D*(\d+)\s*:\s*(\d+)"
SPLIT_PATTERN = r"(?is)from\s+r[se]\.?\s*(\d+(?:\.\d+)?)\s*/?-?\s*.*?to\s+r[se]\.?\s*(\d+(?:\.\d+)?)\s*/?-?"


def bonus_values(text: Column) -> tuple[Column, Column]:
    """Of ``N:M`` new for held: (M + N, M) as face values before and after; nulls if absent or M is 0."""
    part = lambda k: F.nullif(F.regexp_extract(text, BONUS_PATTERN, k), F.lit("")).try_cast("decimal(20,6)")
    n, m = part(1), F.nullif(part(2), F.lit(0).cast("decimal(20,6)"))
    return (m + n).cast("decimal(20,6)"), F.when(n.isNotNull(), m)


def split_values(text: Column) -> tuple[Column, Column]:
    """Of ``From Rs X .. To Re Y``: (X, Y); nulls if absent or X is 0."""
    part = lambda k: F.nullif(F.regexp_extract(text, SPLIT_PATTERN, k), F.lit("")).try_cast("decimal(20,6)")
    x = F.nullif(part(1), F.lit(0).cast("decimal(20,6)"))
    return x, F.when(x.isNotNull(), part(2))


def adjustment_factor(old: Column, new: Column) -> Column:
    """new / old to six decimals, half to even; null if either is missing or old is 0."""
    return F.bround(F.try_divide(new, old), 6).cast("decimal(20,6)")


def ratios_agree(a: Column, b: Column, tolerance: float = 0.0001) -> Column:
    """Whether two factors agree; null if either is unknown."""
    return F.abs(a.cast("double") - b.cast("double")) <= tolerance


def ticker(symbol: Column, exchange: Column, code: Column) -> Column:
    return F.when(F.upper(exchange).startswith("BSE"), F.concat(blank_to_null(code), F.lit(".BO"))).otherwise(F.concat(blank_to_null(symbol), F.lit(".NS")))


def zero_to_null(c: Column) -> Column:
    """A number from a text; placeholder zeros and what is no number are missing."""
    return F.nullif(c.try_cast("double"), F.lit(0.0))


def fits(c: Column, precision: int, scale: int) -> Column:
    """Whether a double is finite and within DECIMAL(precision, scale)."""
    return ~F.isnan(c) & (F.abs(c) < float(10 ** (precision - scale)))


def sanitised(c: Column, precision: int, scale: int) -> Column:
    return F.when(fits(c, precision, scale), c)


def ceiling_date(ts: Column, cutoff_hour: int = 19, offset: str = "+05:30") -> Column:
    """The local day if the cutoff hour is reached, else the day before."""
    local = F.from_utc_timestamp(ts, offset)
    return F.when(F.hour(local) >= cutoff_hour, F.to_date(local)).otherwise(F.date_sub(F.to_date(local), 1))


def in_window(ts: Column, opens: int = 19, closes: int = 9, offset: str = "+05:30") -> Column:
    """Whether the local hour lies in a daily window; one that opens after it closes spans midnight."""
    h = F.hour(F.from_utc_timestamp(ts, offset))
    return (h >= opens) & (h < closes) if opens <= closes else (h >= opens) | (h < closes)


def seconds_until_open(ts: Column, opens: int = 19, closes: int = 9, offset: str = "+05:30") -> Column:
    local = F.from_utc_timestamp(ts, offset)
    past = F.hour(local) * 3600 + F.minute(local) * 60 + F.floor(F.second(local))
    return F.when(in_window(ts, opens, closes, offset), 0).otherwise(F.pmod(F.lit(opens * 3600) - past, F.lit(86400))).cast("bigint")
