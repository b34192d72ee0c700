"""Scalar expressions: guarded ratios, time keys and text parsing."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MICROS_PER_DAY = 86_400_000_000

# The words a text response may use for 1 and for 0.
TRUE_WORDS = ("y", "yes", "t", "true", "on", "1")
FALSE_WORDS = ("n", "no", "f", "false", "off", "0")


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def ratio(
    numerator: Column | str,
    denominator: Column | str,
    guard: Column | str | None = None,
    default: float = 0.0,
) -> Column:
    """``numerator / denominator`` in double precision.

    Gives ``default`` where ``guard`` (the denominator unless named) is zero, and
    NULL where the denominator is zero but the guard is not.
    """
    den = as_column(denominator).cast("double")
    zero_test = den if guard is None else as_column(guard).cast("double")
    value = F.try_divide(as_column(numerator).cast("double"), den)
    return F.when(zero_test == 0.0, F.lit(float(default))).otherwise(value)


def day_number(column: Column | str) -> Column:
    """Calendar day as days since 1970-01-01."""
    return F.unix_date(as_column(column).cast("date"))


def instant_micros(df: DataFrame, column: str) -> Column:
    """Microseconds since the epoch.

    A zoneless timestamp is read off its own clock fields, so that a day is always
    24 hours whatever the session time zone.
    """
    c = F.col(column)
    if isinstance(df.schema[column].dataType, T.TimestampNTZType):
        seconds = F.date_part(F.lit("SECOND"), c)
        return (
            day_number(c).cast("long") * F.lit(MICROS_PER_DAY)
            + F.hour(c).cast("long") * F.lit(3_600_000_000)
            + F.minute(c).cast("long") * F.lit(60_000_000)
            + (seconds * F.lit(1_000_000)).cast("long")
        )
    return F.unix_micros(c.cast("timestamp"))


def whole_number(text: Column | str, invalid: int | None = 0) -> Column:
    """Integer in a text column; text that is no number becomes ``invalid``.

    NULL text stays NULL. ``invalid=None`` keeps unparsable text out of averages.
    """
    c = as_column(text)
    parsed = F.trim(c).try_cast("int")
    if invalid is None:
        return parsed
    return F.when(c.isNotNull(), F.coalesce(parsed, F.lit(invalid)))


def truth_label(column: Column | str) -> Column:
    """0/1 from yes/no-like text; any other text raises when the row is read."""
    c = as_column(column)
    word = F.lower(c)
    return (
        F.when(word.isin(*TRUE_WORDS), F.lit(1))
        .when(word.isin(*FALSE_WORDS), F.lit(0))
        .when(c.isNotNull(), F.raise_error(F.concat(F.lit("not a truth word: "), c)).cast("int"))
    )


def threshold_flag(column: Column | str, above: str = "1", otherwise: str = "0") -> Column:
    """Text flag for values greater than zero; NULL counts as not greater."""
    return F.when(as_column(column) > 0, F.lit(above)).otherwise(F.lit(otherwise))


def clean_double(column: Column | str) -> Column:
    """Double with NaN turned into NULL, so both count as missing."""
    return F.nanvl(as_column(column).cast("double"), F.lit(None).cast("double"))


def pick(names: list[str], index: Column | str) -> Column:
    """The name at a zero-based position, the inverse of exploding by position."""
    return F.element_at(F.array(*[F.lit(n) for n in names]), as_column(index) + 1)


def total(columns: list[Column]) -> Column:
    return reduce(add, columns)
