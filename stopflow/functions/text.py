"""Text cleaning as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the number texts the published loader accepts. Spark's own cast
# also takes Java suffixes ("100D"), so the pattern is checked first.
NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"

#: Unicode white space.
WHITE = "\t\n\v\f\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def strip(c: Column) -> Column:
    """Trim all Unicode white space, including non-breaking spaces."""
    return F.trim(c, F.lit(WHITE))


def number(c: Column) -> Column:
    """Text to double, NULL when it is not a plain decimal number."""
    return F.regexp_extract(strip(c), NUMBER, 0).try_cast("double")


def count_or_zero(c: Column) -> Column:
    """Text to a whole number: fractions truncated, anything unreadable 0."""
    return F.coalesce(number(c).try_cast("bigint"), F.lit(0).cast("bigint"))


def code(c: Column) -> Column:
    """One spelling per code: '100.0' becomes '100', NULL becomes '0'."""
    return F.coalesce(number(c).try_cast("bigint").cast("string"), strip(c), F.lit("0"))


def stop_name(c: Column) -> Column:
    """Stops are stored in capitals without outer spaces."""
    return F.upper(strip(c))


def column_name(category: str) -> str:
    """Column name of a pivoted category."""
    return category.lower().replace(" ", "_").replace("'", "").replace("-", "_")
