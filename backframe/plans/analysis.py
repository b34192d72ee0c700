"""The whole analysis of a data set: column kinds, tables of pairs, and the data of its charts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from backframe.functions.expressions import threshold_flag
from backframe.operators import association, distribution, lowess, pairs, prepare, relational, selection
from backframe.sources.report import report


@dataclass(frozen=True)
class Analysis:
    """``tables`` go into a ranked report; ``charts`` hold what a drawing would need."""

    spec: prepare.FeatureSpec
    response_kind: str
    tables: dict[str, tuple[DataFrame, list[str], str]]
    charts: dict[str, DataFrame]

    def report(self) -> DataFrame:
        return report(self.tables)


def analyse(df: DataFrame, response: str, bins: int = 10, bin_width: float = 0.2) -> Analysis:
    """Which predictors, and which pairs of them, tell something about the response.

    Column kinds come from the schema. A response with exactly two values is categorical,
    and yes/no-like text is read as 1 and 0. Sections without suitable columns are left out.
    """
    spec = prepare.classify_columns(df, response)
    kind = prepare.response_kind(df, response).first()["kind"]
    data = prepare.binary_response(df, response) if kind == "categorical" else df
    con, cat = list(spec.continuous), list(spec.categorical)
    both = ["x1", "x2"]
    tables: dict[str, tuple[DataFrame, list[str], str]] = {}
    charts: dict[str, DataFrame] = {}
    if con:
        tables["con/con correlation"] = (association.pearson(data, con), both, "value")
    if con and cat:
        tables["cat/con correlation"] = (
            association.correlation_ratio(data, cat, con), both, "value",
        )
    if cat:
        tables["cat/cat correlation"] = (association.cramers_v(data, cat), both, "value")
    if len(cat) > 1:
        tables["cat/cat difference"] = (
            pairs.brute_force(data, response, categorical=cat), both, "wmse",
        )
    if len(con) > 1:
        tables["con/con difference"] = (
            pairs.brute_force(data, response, continuous=con, bins=bins), both, "wmse",
        )
    if con and cat:
        tables["cat/con difference"] = (
            pairs.brute_force(data, response, con, cat, bins=bins), both, "wmse",
        )
    if kind == "categorical":
        flagged = data.withColumn("__answer", threshold_flag(response, "True", "False"))
        for c in cat:
            charts[f"contingency {c}"] = relational.observed_cells(flagged, c, "__answer")
        if con:
            repeated = prepare.duplicate_columns(data.select(*con))
            distinct = [c for c in con if c not in repeated]
            charts["distributions"] = distribution.class_histogram(
                data, distinct, response, bin_width
            )
            charts["densities"] = distribution.class_kde(data, distinct, response)
    else:
        if con:
            charts["trends"] = distribution.ols_trend(data, con, response)
        for c in cat:
            charts[f"distribution {c}"] = distribution.class_histogram(
                data, [response], c, bin_width
            )
    return Analysis(spec, kind, tables, charts)


def judge_features(
    df: DataFrame, response: str, trees: int = 50, seed: int = 1, bins: int = 10
) -> Analysis:
    """The analysis of numeric features against a 0/1 outcome, with a summary per feature."""
    spec = prepare.classify_columns(df, response)
    con = list(spec.continuous)
    both = ["x1", "x2"]
    summary = selection.feature_summary(df, con, response, trees, seed, bins)
    tables = {
        "con/con correlation": (association.pearson(df, con), both, "value"),
        "con/con difference": (
            pairs.brute_force(df, response, con, bins=bins, score="between"), both, "wmse",
        ),
        "features": (summary, ["name"], "importance"),
    }
    charts = {
        "features": selection.printed_statistics(summary),
        "binned response": pairs.binned_response(df, response, con, bins),
        "distributions": distribution.class_histogram(df, con, response),
        "trends": lowess.lowess_trend(df, con, response),
    }
    return Analysis(spec, "categorical", tables, charts)


def best_features(analysis: Analysis, least_importance: float | None = None) -> list[str]:
    """Features that are significant or important, the most important first."""
    summary = analysis.tables["features"][0]
    kept = selection.prune_weak(summary, least_importance=least_importance)
    return [r["name"] for r in kept.orderBy(F.col("importance").desc(), "name").collect()]
