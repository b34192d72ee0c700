"""Feature analysis as named queries, over line items joined with their order and part."""

from __future__ import annotations

import itertools

from pyspark.sql import functions as F

from backframe.functions.expressions import pick
from backframe.operators import association, bins, distribution, lowess, pairs, sketches
from backframe.plans.analysis import analyse
from backframe.plans.registry import query
from backframe.plans.tables import CATEGORICAL, CONTINUOUS, load, view_sql
from backframe.session import stored
from backframe.sources.report import ranked, report

SALES = view_sql("sales")
RESPONSE = "returned"
_BINS = 10


def rounded(df, digits=6):
    return df.select(
        *[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    )


def _union(parts) -> str:
    return " UNION ALL ".join(parts)


def _pearson_sql(names) -> str:
    return _union(
        f"SELECT '{a}' AS x1, '{b}' AS x2, round(corr({a}, {b}), 6) AS value FROM sales"
        for a, b in itertools.product(names, names)
    )


@query("corr_pearson", SALES + _pearson_sql(CONTINUOUS))
def corr_pearson(spark, sf):
    return rounded(association.pearson(load(spark, sf, "sales"), CONTINUOUS))


def _eta_sql(cat, con) -> str:
    return _union(
        f"""SELECT '{a}' AS x1, '{b}' AS x2, round((
            SELECT sqrt(sum(n * (m - o.mu) * (m - o.mu)) / any_value(o.ss))
            FROM (SELECT {a} AS lv, count(*) AS n, avg({b}) AS m FROM sales GROUP BY 1) g,
                 (SELECT avg({b}) AS mu, var_pop({b}) * count(*) AS ss FROM sales) o), 6) AS value"""
        for a, b in itertools.product(cat, con)
    )


@query("corr_ratio", SALES + _eta_sql(CATEGORICAL, CONTINUOUS))
def corr_ratio(spark, sf):
    return rounded(
        association.correlation_ratio(load(spark, sf, "sales"), CATEGORICAL, CONTINUOUS)
    )


def _cramer_sql(names, corrected: bool) -> str:
    parts = []
    for a, b in itertools.product(names, names):
        phi = "(share - 1)"
        narrow = "least(r, k) - 1"
        if corrected:
            phi = "greatest(share - 1 - (k - 1) * (r - 1) / (n - 1), 0)"
            narrow = "least(r - (r - 1) * (r - 1) / (n - 1), k - (k - 1) * (k - 1) / (n - 1)) - 1"
        parts.append(
            f"""SELECT '{a}' AS x1, '{b}' AS x2,
                       round(sqrt(greatest({phi}, 0) / ({narrow})), 6) AS value FROM (
            SELECT sum(o * o / (rn * cn)) AS share, CAST(count(DISTINCT a) AS DOUBLE) AS r,
                   CAST(count(DISTINCT b) AS DOUBLE) AS k, sum(o) AS n FROM (
              SELECT a, b, o, sum(o) OVER (PARTITION BY a) AS rn, sum(o) OVER (PARTITION BY b) AS cn
              FROM (SELECT {a} AS a, {b} AS b, CAST(count(*) AS DOUBLE) AS o FROM sales
                    GROUP BY {a}, {b})))"""
        )
    return _union(parts)


@query("corr_cramers_v", SALES + _cramer_sql(CATEGORICAL, True))
def corr_cramers_v(spark, sf):
    return rounded(association.cramers_v(load(spark, sf, "sales"), CATEGORICAL))


@query("corr_cramers_v_plain", SALES + _cramer_sql(CATEGORICAL, False))
def corr_cramers_v_plain(spark, sf):
    return rounded(
        association.cramers_v(load(spark, sf, "sales"), CATEGORICAL, bias_correction=False)
    )


def _bin_sql(c: str) -> str:
    edges = " + ".join(
        f"CASE WHEN {c} > lo_{c} + {k} * st_{c} THEN 1 ELSE 0 END" for k in range(1, _BINS)
    )
    return f"({edges})"


BINNED = (
    SALES
    + ", e AS (SELECT "
    + ", ".join(
        f"min({c}) AS lo_{c}, (max({c}) - min({c})) / CAST({_BINS} AS DOUBLE) AS st_{c}"
        for c in CONTINUOUS
    )
    + " FROM sales), binned AS (SELECT "
    + ", ".join(f"{_bin_sql(c)} AS b_{c}" for c in CONTINUOUS)
    + ", "
    + ", ".join(CATEGORICAL)
    + f", CAST({RESPONSE} AS DOUBLE) AS y, (SELECT avg({RESPONSE}) FROM sales) AS mu, "
    "(SELECT count(*) FROM sales) AS total FROM sales CROSS JOIN e) "
)


@query(
    "equal_width_bins",
    BINNED
    + _union(
        f"SELECT '{c}' AS name, b_{c} AS bin, count(*) AS n, "
        f"round(lo_{c} + (b_{c} + 1) * st_{c}, 6) AS upper FROM binned CROSS JOIN e "
        f"GROUP BY 2, lo_{c}, st_{c}"
        for c in CONTINUOUS
    ),
)
def equal_width_bins(spark, sf):
    sales = load(spark, sf, "sales")
    ranges = bins.overview(sales, CONTINUOUS, _BINS).ranges
    edges = bins.bin_edges(sales, CONTINUOUS, ranges)
    indexed = bins.binned(sales, CONTINUOUS, ranges)
    counted = (
        indexed.select(F.posexplode("bins").alias("i", "bin"))
        .groupBy(pick(CONTINUOUS, "i").alias("name"), "bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return counted.join(edges, ["name", "bin"]).select(
        "name", "bin", "n", F.round("upper", 6).alias("upper")
    )


def _brute_sql(combos, score: str) -> str:
    parts = []
    for (n1, c1), (n2, c2) in combos:
        if score == "within":
            mse, wmse = "avg(d)", "avg(d * n / total)"
            d = "avg((y - mu) * (y - mu))"
        else:
            mse, wmse = "sum(d) / count(*)", "sum(d * n) / sum(n)"
            d = "(avg(y) - any_value(mu)) * (avg(y) - any_value(mu))"
        parts.append(
            f"SELECT '{n1}' AS x1, '{n2}' AS x2, round({mse}, 6) AS mse, round({wmse}, 6) AS wmse "
            f"FROM (SELECT {d} AS d, count(*) AS n, any_value(total) AS total FROM binned "
            f"GROUP BY {c1}, {c2})"
        )
    return BINNED + _union(parts)


_CON = [(c, f"b_{c}") for c in CONTINUOUS]
_CAT = [(c, c) for c in CATEGORICAL]


@query("brute_cat_cat", _brute_sql(list(itertools.combinations(_CAT, 2)), "within"))
def brute_cat_cat(spark, sf):
    return rounded(
        pairs.brute_force(load(spark, sf, "sales"), RESPONSE, categorical=CATEGORICAL)
    )


@query("brute_con_con", _brute_sql(list(itertools.combinations(_CON, 2)), "within"))
def brute_con_con(spark, sf):
    return rounded(pairs.brute_force(load(spark, sf, "sales"), RESPONSE, continuous=CONTINUOUS))


@query("brute_cat_con", _brute_sql(list(itertools.product(_CAT, _CON)), "within"))
def brute_cat_con(spark, sf):
    return rounded(
        pairs.brute_force(
            load(spark, sf, "sales"), RESPONSE, continuous=CONTINUOUS, categorical=CATEGORICAL
        )
    )


@query("brute_con_con_mor", _brute_sql(list(itertools.combinations(_CON, 2)), "between"))
def brute_con_con_mor(spark, sf):
    return rounded(
        pairs.brute_force(
            load(spark, sf, "sales"), RESPONSE, continuous=CONTINUOUS, score="between"
        )
    )


@query(
    "pair_cells",
    BINNED
    + _union(
        f"SELECT '{n1}' AS x1, '{n2}' AS x2, {c1} AS cell1, {c2} AS cell2, count(*) AS n, "
        f"round(avg(y), 9) AS mean FROM binned GROUP BY {c1}, {c2}"
        for (n1, c1), (n2, c2) in itertools.combinations(_CON, 2)
    ),
)
def pair_cells(spark, sf):
    cells = pairs.cells(load(spark, sf, "sales"), RESPONSE, continuous=CONTINUOUS)
    return rounded(cells.select("x1", "x2", "cell1", "cell2", "n", "mean"), 9)


# Documents are labelled in part: those without a label have no response.
LABELLED = """WITH labelled AS (SELECT d.lang, d.source, d.n_chars, CAST(l.toxic AS DOUBLE) AS y
    FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id),
  told AS (SELECT *, (SELECT avg(y) FROM labelled) AS mu, (SELECT count(y) FROM labelled) AS total
    FROM labelled WHERE y IS NOT NULL) """


def labelled(spark, sf):
    labels = load(spark, sf, "labels").select("doc_id", F.col("toxic").cast("double").alias("y"))
    return load(spark, sf, "documents").join(labels, "doc_id", "left")


@query(
    "brute_missing_response",
    LABELLED + "SELECT 'lang' AS x1, 'source' AS x2, round(avg(d), 6) AS mse, round(avg(d * n / total), 6) AS wmse "
    "FROM (SELECT avg((y - mu) * (y - mu)) AS d, count(*) AS n, any_value(total) AS total FROM told "
    "GROUP BY lang, source)",
)
def brute_missing_response(spark, sf):
    """Rows without a response count in no cell."""
    return rounded(pairs.brute_force(labelled(spark, sf), "y", categorical=["lang", "source"]))


@query(
    "mean_of_response_missing",
    LABELLED
    + f""", e AS (SELECT min(n_chars) AS lo, (max(n_chars) - min(n_chars)) / CAST({_BINS} AS DOUBLE) AS st FROM told)
    SELECT 'n_chars' AS name, round(sum(d) / CAST({_BINS} AS DOUBLE), 9) AS mse,
           round(sum(d * n) / sum(n), 9) AS wmse
    FROM (SELECT (avg(y) - any_value(mu)) * (avg(y) - any_value(mu)) AS d, count(*) AS n
          FROM (SELECT *, {_bin_sql("n_chars").replace("lo_n_chars", "lo").replace("st_n_chars", "st")} AS b
                FROM told CROSS JOIN e) GROUP BY b)""",
)
def mean_of_response_missing(spark, sf):
    return rounded(pairs.mean_of_response(labelled(spark, sf), "y", ["n_chars"]), 9)


@query(
    "rank_pairs",
    BINNED
    + "SELECT x1, x2, wmse, row_number() OVER (ORDER BY wmse DESC, x1, x2) AS rank FROM ("
    + _brute_sql(list(itertools.combinations(_CON, 2)), "between").removeprefix(BINNED)
    + ") QUALIFY rank <= 10",
)
def rank_pairs(spark, sf):
    """The ten pairs with the highest weighted score, a report of fixed length."""
    scores = rounded(
        pairs.brute_force(
            load(spark, sf, "sales"), RESPONSE, continuous=CONTINUOUS, score="between"
        )
    )
    top = scores.orderBy(F.col("wmse").desc(), "x1", "x2").limit(10)
    return ranked(top, "wmse", ["x1", "x2"]).select("x1", "x2", "wmse", "rank")


@query(
    "mean_of_response",
    BINNED
    + _union(
        f"SELECT '{c}' AS name, round(sum(d) / CAST({_BINS} AS DOUBLE), 9) AS mse, "
        f"round(sum(d * n) / sum(n), 9) AS wmse FROM (SELECT (avg(y) - any_value(mu)) * "
        f"(avg(y) - any_value(mu)) AS d, count(*) AS n FROM binned GROUP BY b_{c})"
        for c in CONTINUOUS
    ),
)
def mean_of_response(spark, sf):
    return rounded(pairs.mean_of_response(load(spark, sf, "sales"), RESPONSE, CONTINUOUS), 9)


def _histogram_sql(names, by: str, width: str) -> str:
    return SALES + _union(
        f"""SELECT '{c}' AS name, k AS class, CAST(floor((v - lo) / {width}) AS BIGINT) AS bin,
                   count(*) AS n, round(count(*) / (any_value(total) * {width}), 6) AS density
            FROM (SELECT CAST({by} AS VARCHAR) AS k, {c} AS v,
                         min({c}) OVER (PARTITION BY {by}) AS lo,
                         count(*) OVER (PARTITION BY {by}) AS total FROM sales) GROUP BY 2, 3"""
        for c in names
    )


@query("class_histogram", _histogram_sql(CONTINUOUS, RESPONSE, "CAST(0.2 AS DOUBLE)"))
def class_histogram(spark, sf):
    """Continuous predictors by a two-valued response."""
    out = distribution.class_histogram(load(spark, sf, "sales"), CONTINUOUS, RESPONSE)
    return rounded(out.drop("start"))


@query("level_histogram", _histogram_sql(["extendedprice"], "brand", "CAST(500.0 AS DOUBLE)"))
def level_histogram(spark, sf):
    """A continuous response by the levels of a categorical predictor."""
    out = distribution.class_histogram(
        load(spark, sf, "sales"), ["extendedprice"], "brand", width=500.0
    )
    return rounded(out.drop("start"))


_CURVED = CONTINUOUS
_POINTS = 40


@query(
    "class_kde",
    SALES
    + _union(
        f"""SELECT '{c}' AS name, s.k AS class, p.i AS point,
                   round(sum(v.n * exp(-0.5 * pow((s.lo + p.i * (s.hi - s.lo) /
                         CAST({_POINTS - 1} AS DOUBLE) - v.x) / s.h, 2)))
                         / (any_value(s.total) * any_value(s.h) * sqrt(2 * pi())), 6) AS density
            FROM (SELECT CAST({RESPONSE} AS VARCHAR) AS k, min({c}) AS lo, max({c}) AS hi,
                         count(*) AS total, stddev_samp({c}) * pow(count(*), -0.2) AS h
                  FROM sales GROUP BY 1) s
            JOIN (SELECT CAST({RESPONSE} AS VARCHAR) AS k, {c} AS x, count(*) AS n
                  FROM sales GROUP BY 1, 2) v ON v.k = s.k
            CROSS JOIN (SELECT CAST(range AS INT) AS i FROM range({_POINTS})) p GROUP BY 2, 3"""
        for c in _CURVED
    ),
)
def class_kde(spark, sf):
    curves = distribution.class_kde(
        load(spark, sf, "sales"), _CURVED, RESPONSE, points=_POINTS
    )
    return rounded(curves.drop("x"))


@query(
    "box_summary",
    SALES
    + _union(
        f"SELECT '{c}' AS name, CAST({RESPONSE} AS VARCHAR) AS class, count(*) AS n, min({c}) AS lo, "
        f"round(quantile_cont({c}, 0.25), 6) AS q1, round(quantile_cont({c}, 0.5), 6) AS median, "
        f"round(quantile_cont({c}, 0.75), 6) AS q3, max({c}) AS hi FROM sales GROUP BY 2"
        for c in CONTINUOUS
    ),
)
def box_summary(spark, sf):
    return rounded(distribution.box_summary(load(spark, sf, "sales"), CONTINUOUS, RESPONSE))


_PREDICTORS = [c for c in CONTINUOUS if c != "extendedprice"]


@query(
    "ols_trend",
    SALES
    + _union(
        f"SELECT '{c}' AS name, round(regr_slope(extendedprice, {c}), 4) AS slope, "
        f"round(regr_intercept(extendedprice, {c}), 4) AS intercept, "
        f"round(regr_r2(extendedprice, {c}), 4) AS r2 FROM sales"
        for c in _PREDICTORS
    ),
)
def ols_trend(spark, sf):
    return rounded(
        distribution.ols_trend(load(spark, sf, "sales"), _PREDICTORS, "extendedprice"), 4
    )


@query("lowess_trend")
def lowess_trend(spark, sf):
    return rounded(
        lowess.lowess_trend(load(spark, sf, "sales"), CONTINUOUS, RESPONSE)
    )


_STEPPED = ["quantity", "discount", "tax", "retailprice", "part_size"]


@query(
    "lowess_trend_plain",
    SALES
    + "".join(
        f", p_{c} AS (SELECT {c} AS x, count(*) AS n, avg({RESPONSE}) AS y FROM sales GROUP BY 1)"
        for c in _STEPPED
    )
    + _union(
        f"""SELECT '{c}' AS name, x0 AS x, round(my + CASE WHEN sxx > 0 THEN
                   (x0 - mx) * sxy / sxx ELSE 0 END, 6) AS fit
            FROM (SELECT x0, sum(w * x) / sum(w) AS mx, sum(w * y) / sum(w) AS my,
                         sum(w * x * x) - sum(w * x) * sum(w * x) / sum(w) AS sxx,
                         sum(w * x * y) - sum(w * x) * sum(w * y) / sum(w) AS sxy
                  FROM (SELECT x0, x, y, n * pow(greatest(1 - pow(d / h, 3), 0), 3) AS w
                        FROM (SELECT *, min(CASE WHEN upto >= floor(total * 2.0 / 3) THEN d END)
                                        OVER (PARTITION BY x0) AS h
                              FROM (SELECT *, sum(n) OVER (PARTITION BY x0 ORDER BY d) AS upto
                                    FROM (SELECT a.x AS x0, b.x, b.n, b.y, abs(a.x - b.x) AS d,
                                                 (SELECT count(*) FROM sales) AS total
                                          FROM p_{c} a CROSS JOIN p_{c} b))))
                  GROUP BY x0)"""
        for c in _STEPPED
    ),
)
def lowess_trend_plain(spark, sf):
    """Columns whose values SQL can pair with each other, and no reweighting."""
    curves = lowess.lowess_trend(load(spark, sf, "sales"), _STEPPED, RESPONSE, rounds=0)
    return curves.withColumn("fit", F.round("fit", 6))


_FRACTIONS = {"1-URGENT": 0.2, "2-HIGH": 0.1, "3-MEDIUM": 0.05, "4-NOT SPECIFIED": 0.02, "5-LOW": 0.01}


@query(
    "scatter_sample",
    "SELECT o_orderkey, o_orderpriority, o_totalprice, round(log10(o_totalprice), 6) "
    "AS log10_o_totalprice FROM orders WHERE o_totalprice > 0 AND "
    "CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8) AS BIGINT) < 4294967296.0 * "
    "CASE o_orderpriority "
    + " ".join(f"WHEN '{k}' THEN {v}" for k, v in _FRACTIONS.items())
    + " ELSE 0 END",
)
def scatter_sample(spark, sf):
    points = distribution.scatter_sample(
        load(spark, sf, "orders"), "o_orderkey", ["o_totalprice"], "o_orderpriority",
        _FRACTIONS, log_columns=["o_totalprice"],
    )
    return points.where("o_totalprice > 0").withColumn(
        "log10_o_totalprice", F.round("log10_o_totalprice", 6)
    )


def _section_sql(text: str, score: str) -> str:
    return f"SELECT x1 || ' x ' || x2 AS item, {score} AS score FROM ({text.removeprefix(BINNED)})"


_SECTIONS = {
    "con/con correlation": _section_sql(_pearson_sql(CONTINUOUS), "value"),
    "cat/con correlation": _section_sql(_eta_sql(CATEGORICAL, CONTINUOUS), "value"),
    "cat/cat correlation": _section_sql(_cramer_sql(CATEGORICAL, True), "value"),
    "cat/cat difference": _section_sql(_brute_sql(list(itertools.combinations(_CAT, 2)), "within"), "wmse"),
    "con/con difference": _section_sql(_brute_sql(list(itertools.combinations(_CON, 2)), "within"), "wmse"),
    "cat/con difference": _section_sql(_brute_sql(list(itertools.product(_CAT, _CON)), "within"), "wmse"),
}


@query(
    "report_sections",
    BINNED
    + _union(
        f"SELECT '{name}' AS section, row_number() OVER (ORDER BY score DESC, item) AS rank, "
        f"item, score FROM ({text})"
        for name, text in _SECTIONS.items()
    ),
)
def report_sections(spark, sf):
    """All tables of pairs of the whole analysis, ranked and stacked."""
    sales = stored(load(spark, sf, "sales").select(*CONTINUOUS, *CATEGORICAL, RESPONSE), "sales")
    found = analyse(sales, RESPONSE).tables
    return report({name: (rounded(df), labels, score) for name, (df, labels, score) in found.items()})


_SHARES = (0.01, 0.25, 0.5, 0.75, 0.99)


@query(
    "quantile_sketch",
    "SELECT name, p, true AS within FROM (VALUES "
    + ", ".join(f"('{c}')" for c in CONTINUOUS)
    + ") n(name) CROSS JOIN (VALUES "
    + ", ".join(f"(CAST({p} AS DOUBLE))" for p in _SHARES)
    + ") s(p)",
)
def quantile_sketch(spark, sf):
    """Whether quantiles of sketches per status and priority, merged, have ranks within the error that is stated."""
    sales = load(spark, sf, "sales")
    parts = stored(sketches.quantile_sketches(sales, CONTINUOUS, ["linestatus", "orderpriority"], 400), "sketches")
    told = stored(sketches.sketched_quantiles(sketches.merged_sketches(parts), _SHARES), "quantiles")
    values = F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("v")) for c in CONTINUOUS]))
    ranks = (
        sales.select(values.alias("r")).select("r.*").join(F.broadcast(told), "name").groupBy("name", "p")
        .agg(F.avg((F.col("v") < F.col("value")).cast("int")).alias("below"), F.avg((F.col("v") <= F.col("value")).cast("int")).alias("upto"))
    )
    off = F.greatest(F.col("below") - F.col("p"), F.col("p") - F.col("upto"), F.lit(0.0))
    return ranks.select("name", "p", (off <= 1.5 * sketches.rank_error(400)).alias("within"))
