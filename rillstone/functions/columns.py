"""Scalar expressions: keys, tolerant parsing, rounding, calendar parts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text standing for NULL inside a surrogate key, and the key separator.
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"
SURROGATE_SEPARATOR = "-"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- keys

def hash_key(*cols: Column | str) -> Column:
    """64-bit key over several columns in which NULLs keep their position.

    ``xxhash64`` alone skips NULL arguments, so (NULL, 'a') and ('a', NULL)
    would collide; hashing the is-null flags along with the values avoids it.
    """
    parts = []
    for c in map(_col, cols):
        parts += [c.isNull(), c]
    return F.xxhash64(*parts)


def surrogate_key(*cols: Column | str) -> Column:
    """MD5 text key over the text form of each column, NULLs replaced by a marker."""
    texts = [F.coalesce(_col(c).cast("string"), F.lit(SURROGATE_NULL)) for c in cols]
    return F.md5(F.concat_ws(SURROGATE_SEPARATOR, *texts))


# ---------------------------------------------------------------- text

def clean_token(c: Column | str) -> Column:
    """Upper-case token with every run of other characters turned into one underscore."""
    return F.upper(F.regexp_replace(_col(c), "[^a-zA-Z0-9]+", "_"))


def text_before(c: Column | str, delimiter: str) -> Column:
    """Part of the text before the first delimiter (the whole text if there is none)."""
    return F.substring_index(_col(c), delimiter, 1)


def char_length(c: Column | str) -> Column:
    return F.char_length(_col(c))


# ---------------------------------------------------------------- tolerant parsing

def parse_number(c: Column | str, whole: bool = False) -> Column:
    """Number from text; anything unreadable ('NA', '') becomes NULL.

    ``whole=True`` rounds to an integer, as a parse into a scale-0 number does.
    """
    trimmed = F.trim(_col(c).cast("string"))
    if whole:
        return F.round(trimmed.try_cast("decimal(38,10)"), 0).cast("double")
    plain = trimmed.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$")  # no 'NaN', 'Infinity' or '12d'
    return F.when(plain, trimmed.try_cast("double"))


def parse_timestamp(c: Column | str, pattern: str = "dd-MM-yyyy HH:mm:ss") -> Column:
    """Timestamp without zone from text in ``pattern``; bad text becomes NULL."""
    return F.try_to_timestamp(_col(c), F.lit(pattern)).cast("timestamp_ntz")


def parse_price(c: Column | str) -> Column:
    """Money text such as ``$1,250.00`` as decimal(10,2); unreadable text becomes NULL."""
    digits = F.replace(F.replace(_col(c), F.lit("$"), F.lit("")), F.lit(","), F.lit(""))
    return digits.try_cast("decimal(10,2)")


# ---------------------------------------------------------------- arithmetic

def greatest_strict(*cols: Column | str) -> Column:
    """Largest argument, NULL when any argument is NULL (plain ``greatest`` skips NULLs)."""
    cols = [_col(c) for c in cols]
    any_null = reduce(lambda a, b: a | b, [c.isNull() for c in cols])
    return F.when(~any_null, F.greatest(*cols))


def row_total(cols: list[Column | str], skip_nulls: bool) -> Column:
    """Sum across columns of one row, either skipping NULLs or propagating them."""
    terms = [_col(c) for c in cols]
    if skip_nulls:
        terms = [F.coalesce(c, F.lit(0.0)) for c in terms]
    return reduce(lambda a, b: a + b, terms)


def percent_change(now: Column, before: Column, digits: int = 1) -> Column:
    """Change in percent, rounded half to even; NULL when the base is zero or missing."""
    return F.bround(F.try_divide(now - before, before) * 100, digits)


def clamp_max(c: Column | str, ceiling: float) -> Column:
    """Cap a value; NULL stays NULL."""
    c = _col(c)
    return F.when(c > ceiling, F.lit(ceiling)).otherwise(c)


# ---------------------------------------------------------------- calendar

def hour_of(c: Column | str) -> Column:
    return F.date_trunc("hour", _col(c)).cast("timestamp_ntz")


def is_weekend(c: Column | str) -> Column:
    """Saturday or Sunday (day numbers 7 and 1)."""
    return F.dayofweek(_col(c)).isin(1, 7)


def calendar_parts(c: Column | str) -> dict[str, Column]:
    c = _col(c)
    return {
        "year": F.year(c),
        "quarter": F.quarter(c),
        "month": F.month(c),
        "day": F.dayofmonth(c),
        "hour": F.hour(c),
        "day_of_week": F.dayofweek(c),
        "is_weekend": is_weekend(c),
    }


def period_start(year: Column | str, month: Column | str | None = None) -> Column:
    """First day of a year, or of a month when one is given."""
    return F.make_date(_col(year), F.lit(1) if month is None else _col(month), F.lit(1))


def weekday_name(c: Column | str) -> Column:
    return F.date_format(_col(c), "EEE")


def month_name(c: Column | str, full: bool = False) -> Column:
    return F.date_format(_col(c), "MMMM" if full else "MMM")


# ---------------------------------------------------------------- lookups

def lookup(c: Column | str, mapping: dict) -> Column:
    """Value of a literal dictionary; unknown keys give NULL. For a table of keys see ``joins.lookup_table``."""
    pairs = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), _col(c))


def ordinal(c: Column | str, ordered: list) -> Column:
    """Zero-based position in a given order; values outside it give NULL."""
    position = F.array_position(F.array(*[F.lit(v) for v in ordered]), _col(c))
    return F.when(position > 0, position - 1)


# ---------------------------------------------------------------- repeatable randomness

_HEX_DIGITS = 13  # 52 bits: every value is exact in a double


def uniform(seed: int | str, *keys: Column | str) -> Column:
    """Uniform number in [0, 1) that depends only on the seed and the row key.

    ``rand(seed)`` depends on how rows fall into partitions, so a retried or
    re-planned task may draw other values; a hash of the key cannot.
    """
    text = F.concat_ws("|", F.lit(str(seed)), *[_col(k).cast("string") for k in keys])
    prefix = F.substring(F.md5(text), 1, _HEX_DIGITS)
    return F.conv(prefix, 16, 10).cast("double") / float(16**_HEX_DIGITS)


def normal(seed: int | str, *keys: Column | str) -> Column:
    """Standard normal number by the Box-Muller transform of two hashed uniforms."""
    u1 = F.lit(1.0) - uniform(f"{seed}.a", *keys)
    u2 = uniform(f"{seed}.b", *keys)
    return F.sqrt(F.lit(-2.0) * F.ln(u1)) * F.cos(F.lit(2.0) * F.pi() * u2)


def uniform_int(seed: int | str, low: int, high: int, *keys: Column | str) -> Column:
    """Uniform integer, both ends included."""
    return (F.floor(uniform(seed, *keys) * (high - low + 1)) + low).cast("long")
