"""Column preparation: nulls, text, column kinds and duplicate columns."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from backframe.functions.expressions import as_column, clean_double, truth_label

_CONTINUOUS = (
    T.ByteType,
    T.ShortType,
    T.IntegerType,
    T.LongType,
    T.FloatType,
    T.DoubleType,
    T.DecimalType,
)
_CATEGORICAL = (T.StringType, T.BooleanType)


@dataclass(frozen=True)
class FeatureSpec:
    """Which columns play which part in an analysis."""

    continuous: tuple[str, ...]
    categorical: tuple[str, ...]
    response: str


def drop_null_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows complete in the named columns (all by default); NaN counts as missing."""
    return df.na.drop("any", subset=None if columns is None else list(columns))


def fill_zero(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Missing numeric values become 0."""
    return df.na.fill(0, subset=None if columns is None else list(columns))


def impute_mean(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Missing values become their column's mean; the columns become doubles.

    All means come from one pass and reach the rows as a scalar subquery of fixed width.
    """
    means = df.agg(F.array(*[F.avg(clean_double(c)) for c in columns]).alias("m")).scalar()
    filled = {
        c: F.coalesce(clean_double(c), F.get(means, F.lit(i))) for i, c in enumerate(columns)
    }
    return df.withColumns(filled)


def replace_where_like(
    df: DataFrame, column: str, pattern: str, search: str, replacement: str = ""
) -> DataFrame:
    """Conditional update: rewrite the text only of rows matching the pattern."""
    c = F.col(column)
    changed = F.replace(c, F.lit(search), F.lit(replacement))
    return df.withColumn(column, F.when(c.ilike(pattern), changed).otherwise(c))


def classify_columns(df: DataFrame, response: str) -> FeatureSpec:
    """Text and booleans are categorical, numbers continuous; other types are left out."""
    continuous, categorical = [], []
    for field in df.schema.fields:
        if field.name == response:
            continue
        if isinstance(field.dataType, _CATEGORICAL):
            categorical.append(field.name)
        elif isinstance(field.dataType, _CONTINUOUS):
            continuous.append(field.name)
    return FeatureSpec(tuple(continuous), tuple(categorical), response)


def column_kinds(df: DataFrame, response: str) -> DataFrame:
    """The classification as rows, with each column's number of non-null values."""
    spec = classify_columns(df, response)
    kinds = {c: "continuous" for c in spec.continuous}
    kinds.update({c: "categorical" for c in spec.categorical})
    names = [c for c in df.columns if c in kinds]
    counts = df.agg(F.array(*[F.count(c) for c in names]).alias("n"))
    labels = F.array(
        *[F.struct(F.lit(c).alias("column"), F.lit(kinds[c]).alias("kind")) for c in names]
    )
    return counts.select(F.inline(F.arrays_zip(labels.alias("c"), F.col("n")))).select(
        "c.column", "c.kind", F.col("n").alias("n_values")
    )


def response_kind(df: DataFrame, response: str) -> DataFrame:
    """One row: ``categorical`` if the response has exactly two distinct values.

    A missing value counts as a value of its own. Comparing every row with the smallest
    and largest value needs no shuffle of the distinct values.
    """
    c = F.col(response)
    ends = df.agg(F.struct(F.min(c).alias("lo"), F.max(c).alias("hi")).alias("e")).scalar()
    lo, hi = ends["lo"], ends["hi"]
    facts = df.agg(
        F.count_if((c != lo) & (c != hi)).alias("between"),
        F.count_if(c.isNull()).alias("missing"),
        F.count_if(c == lo).alias("at_lo"),
        F.count_if((c == hi) & (lo != hi)).alias("at_hi"),
    )
    values = sum(
        (F.col(n) > 0).cast("int") for n in ("between", "missing", "at_lo", "at_hi")
    )
    two = (values == 2) & (F.col("between") == 0)
    return facts.select(
        F.lit(response).alias("response"),
        F.when(two, "categorical").otherwise("continuous").alias("kind"),
        F.col("missing").alias("n_missing"),
    )


def binary_response(df: DataFrame, response: str, alias: str | None = None) -> DataFrame:
    """A two-valued response as 0/1: text by its truth word, numbers and booleans as is."""
    kind = df.schema[response].dataType
    label = truth_label(response) if isinstance(kind, T.StringType) else F.col(response).cast("int")
    return df.withColumn(alias or response, label)


def _comparable(df: DataFrame, name: str) -> tuple[str, Column]:
    kind = df.schema[name].dataType
    if isinstance(kind, (*_CONTINUOUS, T.BooleanType)):
        number = F.col(name).cast("int") if isinstance(kind, T.BooleanType) else F.col(name)
        return "number", clean_double(number)
    return kind.simpleString(), as_column(name)


def duplicate_columns(df: DataFrame) -> list[str]:
    """Names of the columns whose content a later column repeats in every row.

    One pass gives each column a fingerprint: the xor over rows of a hash of its value and
    the whole row. Equal columns have equal fingerprints. Only columns that share one are
    then compared value by value, in a second pass.
    """
    forms = {c: _comparable(df, c) for c in df.columns}
    row = F.xxhash64(*[form for _, form in forms.values()])
    prints = df.select(
        *[F.xxhash64(form, row).alias(c) for c, (_, form) in forms.items()]
    ).agg(*[F.bit_xor(F.col(f"`{c}`")).alias(c) for c in df.columns])
    seen = prints.first().asDict()
    groups: dict[tuple, list[str]] = {}
    for c in df.columns:
        groups.setdefault((forms[c][0], seen[c]), []).append(c)
    pairs = [
        (a, b) for g in groups.values() for i, a in enumerate(g) for b in g[i + 1 :]
    ]
    if not pairs:
        return []
    same = df.agg(
        *[
            F.coalesce(F.bool_and(forms[a][1].eqNullSafe(forms[b][1])), F.lit(True)).alias(str(i))
            for i, (a, b) in enumerate(pairs)
        ]
    ).first()
    repeated = {a for i, (a, _) in enumerate(pairs) if same[i]}
    return [c for c in df.columns if c in repeated]


def drop_duplicate_columns(df: DataFrame) -> DataFrame:
    """Of columns equal in every row only the last stays."""
    return df.drop(*duplicate_columns(df))
