"""Column helpers shared by all operators.  All of them stay inside code generation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

SECONDS = {"minute": 60.0, "hour": 3600.0}


def round_n(value: Column, digits: int) -> Column:
    """ROUND on doubles in scaled form: 1.005 -> 1.0, as the binary value says.

    Spark's own `round(x, n)` rounds the decimal text of the double instead
    (1.005 -> 1.01).
    """
    scale = 10.0**digits
    return F.round(value.cast("double") * scale) / scale


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double division that gives NULL for a zero denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    return round_n(ratio(100.0 * part.cast("double"), whole), digits)


def cents(amount: Column) -> Column:
    """An amount of money as a whole number of cents.

    Sums of longs are exact in any order, so a re-run task or another
    partitioning cannot change the last digit, and they stay in fast
    primitive arithmetic.  ANSI mode raises on overflow.
    """
    return F.floor(amount.cast("double") * 100.0 + 0.5)


def amount(total_cents: Column) -> Column:
    """Cents back to an amount with two decimals."""
    return total_cents / F.lit(100.0)


def boundaries_crossed(unit: str, start: Column, end: Column) -> Column:
    """How many minute or hour boundaries lie between two timestamps.

    00:00:59 -> 00:01:01 is one minute, though only two seconds passed.
    """
    size = SECONDS[unit]
    return F.floor(F.unix_timestamp(end) / size) - F.floor(F.unix_timestamp(start) / size)


def whole_table_sum(value: Column) -> Column:
    """Total over every row of an already aggregated, small result.

    Only for results with one row per month, state, segment or the like: the
    window puts them all into one partition.
    """
    return F.sum(value).over(Window.partitionBy())


def as_row(df: DataFrame) -> Column:
    """A one-row DataFrame as a struct-valued scalar subquery."""
    return df.select(F.struct(*df.columns).alias("row")).scalar()


def plain_text(value: Column) -> Column:
    """A double as text without an exponent; Spark's own cast writes 1.0E7 from ten million on.

    The shortest digits of the double are kept, only spelled out.  38 digits hold every amount
    and share here; what does not fit stays as it is.
    """
    text, exact = value.cast("string"), value.try_cast("decimal(38,12)")
    spelled = F.regexp_replace(F.regexp_replace(exact.cast("string"), "0+$", ""), r"\.$", ".0")
    return F.when(text.contains("E") & (exact.cast("double") == value), spelled).otherwise(text)
