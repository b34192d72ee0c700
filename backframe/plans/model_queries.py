"""Feature statistics and classifiers as named queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from backframe.operators import deep_forest, firth, models, neighbours, prepare, projections, regression, selection
from backframe.operators.preparation import Preparation
from backframe.plans import games, model_stage
from backframe.plans.analysis_queries import SALES, rounded
from backframe.plans.registry import query
from backframe.plans.table_queries import stored_games
from backframe.plans.tables import CONTINUOUS, load
from backframe.session import stored

RESPONSE = "returned"


@query("logit_univariate")
def logit_univariate(spark, sf):
    return rounded(
        regression.logit_univariate(load(spark, sf, "sales"), CONTINUOUS, RESPONSE)
    )


def _newton_sql(names, rounds: int = 9) -> str:
    """Newton steps for all predictors at once, one step per common table."""
    points = " UNION ALL ".join(
        f"SELECT '{c}' AS name, {c} AS x, CAST({RESPONSE} AS DOUBLE) AS y, count(*) AS n "
        f"FROM sales GROUP BY 2, 3"
        for c in names
    )
    steps = [
        f""", pts AS MATERIALIZED ({points}),
        shape AS MATERIALIZED (SELECT name, sum(n * x) / sum(n) AS m,
            sqrt(sum(n * x * x) / sum(n) - pow(sum(n * x) / sum(n), 2)) AS s, sum(n) AS n
            FROM pts GROUP BY name),
        z AS MATERIALIZED (SELECT p.name, (x - m) / s AS z, y, p.n FROM pts p
            JOIN shape USING (name)),
        s0 AS (SELECT name, CAST(0 AS DOUBLE) AS a, CAST(0 AS DOUBLE) AS b FROM shape)"""
    ]
    sums = """SELECT name, any_value(a) AS a, any_value(b) AS b, sum(n * w) AS w,
            sum(n * w * z) AS wz, sum(n * w * z * z) AS wzz, sum(n * (y - p)) AS g,
            sum(n * (y - p) * z) AS gz
            FROM (SELECT *, p * (1 - p) AS w FROM (SELECT *, 1 / (1 + exp(-a - b * z)) AS p
                  FROM z JOIN {step} USING (name))) GROUP BY name"""
    for k in range(rounds):
        steps.append(
            f"""s{k + 1} AS MATERIALIZED (SELECT name,
            a + (wzz * g - wz * gz) / (w * wzz - wz * wz) AS a,
            b + (w * gz - wz * g) / (w * wzz - wz * wz) AS b
            FROM ({sums.format(step=f's{k}')}))"""
        )
    return (
        SALES
        + ", ".join(steps)
        + f""" SELECT name, round(b / s, 6) AS coefficient,
        round(b / sqrt(w / (w * wzz - wz * wz)), 5) AS z_value, CAST(shape.n AS BIGINT) AS n
        FROM ({sums.format(step=f's{rounds}')}) JOIN shape USING (name)"""
    )


@query("logit_z_values", _newton_sql(CONTINUOUS))
def logit_z_values(spark, sf):
    fits = regression.logit_univariate(load(spark, sf, "sales"), CONTINUOUS, RESPONSE)
    return fits.select(
        "name", F.round("coefficient", 6).alias("coefficient"),
        F.round("z_value", 5).alias("z_value"), "n",
    )


def _firth_sql(names, rounds: int = 14) -> str:
    """The penalised steps; leverages enter by sums of powers, as in the plain ones."""
    text = _newton_sql(names, 0)
    head = text[: text.index(" SELECT name, round(b / s, 6)")]
    sums = """SELECT *, wzz / d AS v00, -wz / d AS v01, w / d AS v11 FROM (SELECT *, w * wzz - wz * wz AS d FROM (
        SELECT name, any_value(a) AS a, any_value(b) AS b, sum(n * w) AS w, sum(n * w * z) AS wz,
        sum(n * w * z * z) AS wzz, sum(n * (y - p)) AS g, sum(n * (y - p) * z) AS gz, sum(n * w * (0.5 - p)) AS c0,
        sum(n * w * (0.5 - p) * z) AS c1, sum(n * w * (0.5 - p) * z * z) AS c2,
        sum(n * w * (0.5 - p) * z * z * z) AS c3
        FROM (SELECT *, p * (1 - p) AS w FROM (SELECT *, 1 / (1 + exp(-a - b * z)) AS p
              FROM z JOIN {step} USING (name))) GROUP BY name))"""
    steps = "".join(
        f""", s{k + 1} AS MATERIALIZED (SELECT name, a + v00 * u + v01 * uz AS a, b + v01 * u + v11 * uz AS b
        FROM (SELECT *, g + v00 * c0 + 2 * v01 * c1 + v11 * c2 AS u, gz + v00 * c1 + 2 * v01 * c2 + v11 * c3 AS uz
              FROM ({sums.format(step=f's{k}')})))"""
        for k in range(rounds)
    )
    return (
        head + steps + f""" SELECT name, round(b / s, 6) AS coefficient, round(b / sqrt(v11), 5) AS z_value,
        CAST(shape.n AS BIGINT) AS n, 'converged' AS status
        FROM ({sums.format(step=f's{rounds}')}) JOIN shape USING (name)"""
    )


@query("logit_firth", _firth_sql(CONTINUOUS))
def logit_firth(spark, sf):
    fits = firth.firth_univariate(load(spark, sf, "sales"), CONTINUOUS, RESPONSE)
    return fits.select(
        "name", F.round("coefficient", 6).alias("coefficient"), F.round("z_value", 5).alias("z_value"), "n", "status"
    )


@query("rf_importance")
def rf_importance(spark, sf):
    return models.forest_importance(load(spark, sf, "sales"), CONTINUOUS, RESPONSE)


@query("feature_summary")
def feature_summary(spark, sf):
    summary = selection.feature_summary(
        load(spark, sf, "sales"), CONTINUOUS, RESPONSE
    )
    return selection.printed_statistics(summary)


_TWINNED = [*CONTINUOUS, "twin"]


@query("prune_correlated")
def prune_correlated(spark, sf):
    """Price per unit follows the retail price closely enough for one of them to go."""
    sales = load(spark, sf, "sales").withColumn(
        "twin", F.col("extendedprice") / F.col("quantity") + F.col("tax")
    )
    sales = stored(sales.select(RESPONSE, *_TWINNED), "sales")
    importance = models.forest_importance(sales, _TWINNED, RESPONSE, is_stored=True)
    return selection.prune_correlated(sales, _TWINNED, importance)


@query("prune_weak")
def prune_weak(spark, sf):
    summary = selection.feature_summary(
        load(spark, sf, "sales"), CONTINUOUS, RESPONSE
    )
    return selection.prune_weak(summary)


@query(
    "label_encode",
    "SELECT brand, CAST(dense_rank() OVER (ORDER BY brand) - 1 AS DOUBLE) AS code, "
    "brand AS decoded, n FROM (SELECT p_brand AS brand, count(*) AS n FROM part GROUP BY 1)",
)
def label_encode(spark, sf):
    parts = load(spark, sf, "part").select(F.col("p_brand").alias("brand"))
    coded, model = models.label_codes(parts, "brand", "code")
    decoded = models.code_labels(coded, "code", "decoded", model)
    return decoded.groupBy("brand", "code", "decoded").agg(F.count(F.lit(1)).alias("n"))


@query(
    "standardize",
    "SELECT o_orderkey, round((o_totalprice - (SELECT avg(o_totalprice) FROM orders)) / "
    "(SELECT stddev_pop(o_totalprice) FROM orders), 6) AS o_totalprice FROM orders",
)
def standardize(spark, sf):
    orders = load(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return rounded(models.standardize(orders, ["o_totalprice"]))


def _games(spark, sf):
    """Feature rows of games, and the predictors among their columns."""
    features = games.pair_features(stored_games(spark, sf), clean=True)
    rest = features.drop("game_id", "local_date", "h_team", "a_team")
    return features, list(prepare.classify_columns(rest, "hometeam_win").continuous)


def _stage(spark, sf, *names):
    """Games cut in time order, means learned on the earlier ones, and the models of these names."""
    features, predictors = _games(spark, sf)
    fits = {n: model_stage.FITS[n] for n in names}
    return model_stage.model_stage(features, predictors, "hometeam_win", "local_date", "game_id", fits=fits)


def _told(stage):
    return stage.predictions.select("game_id", F.col("label").alias("hometeam_win"), "prediction")


@query("rf_classify")
def rf_classify(spark, sf):
    return _told(_stage(spark, sf, "forest"))


@query("logreg_classify")
def logreg_classify(spark, sf):
    return _told(_stage(spark, sf, "logistic"))


@query("deep_forest_classify")
def deep_forest_classify(spark, sf):
    """Trees as deep as the games ask for."""
    features, predictors = _games(spark, sf)
    fits = {"deep forest": lambda train, columns, label: deep_forest.fit_deep_forest(train, columns, label, "game_id")}
    return _told(model_stage.model_stage(features, predictors, "hometeam_win", "local_date", "game_id", fits=fits))


@query("model_comparison")
def model_comparison(spark, sf):
    """Accuracies and F-scores of both models on the same later games."""
    return rounded(_stage(spark, sf, "forest", "logistic").comparison())


@query(
    "model_comparison_rules",
    SALES + """, p AS (SELECT 'linestatus' AS model, returned AS label, CASE WHEN linestatus = 'F' THEN 1 ELSE 0 END AS said FROM sales
      UNION ALL SELECT 'quantity', returned, CASE WHEN quantity > 25 THEN 1 ELSE 0 END FROM sales)
    SELECT model, count(*) AS n, round(avg(CASE WHEN label = said THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
      round(CAST(count(*) FILTER (label = 1 AND said = 1) AS DOUBLE) / count(*) FILTER (said = 1), 6) AS precision,
      round(CAST(count(*) FILTER (label = 1 AND said = 1) AS DOUBLE) / count(*) FILTER (label = 1), 6) AS recall,
      round(2.0 * count(*) FILTER (label = 1 AND said = 1) / (count(*) FILTER (label = 1) + count(*) FILTER (said = 1)), 6) AS f_score
    FROM p GROUP BY model""",
)
def model_comparison_rules(spark, sf):
    """The comparison on predictions that SQL can follow."""
    sales = load(spark, sf, "sales")
    rules = {"linestatus": F.col("linestatus") == "F", "quantity": F.col("quantity") > 25}
    told = [
        sales.select(F.lit(n).alias("model"), F.col("returned").alias("label"), rule.cast("int").alias("prediction"))
        for n, rule in rules.items()
    ]
    return rounded(model_stage.compare(told[0].unionAll(told[1])))


_DAY = "1996-01-01"


@query(
    "fitted_preparation",
    f"""WITH o AS (SELECT o_orderkey, o_orderpriority, o_orderdate < DATE '{_DAY}' AS old,
        CASE WHEN o_orderkey % 7 > 0 THEN CAST(o_totalprice AS DOUBLE) END AS price FROM orders),
    m AS (SELECT avg(price) AS m, stddev_pop(price) AS s FROM o WHERE old),
    l AS (SELECT o_orderpriority, row_number() OVER (ORDER BY o_orderpriority) - 1 AS code FROM o
          WHERE old AND o_orderpriority <> '3-MEDIUM' GROUP BY 1)
    SELECT o_orderkey, round((coalesce(price, m) - m) / s, 6) AS price,
      CAST(coalesce(code, (SELECT count(*) FROM l)) AS DOUBLE) AS o_orderpriority
    FROM o CROSS JOIN m LEFT JOIN l USING (o_orderpriority) WHERE NOT old""",
)
def fitted_preparation(spark, sf):
    """Later orders filled, scaled and coded by earlier ones, one label being new to them."""
    orders = load(spark, sf, "orders").select(
        "o_orderkey", "o_orderpriority", "o_orderdate",
        F.when(F.col("o_orderkey") % 7 > 0, F.col("o_totalprice").cast("double")).alias("price"),
    )
    old = F.col("o_orderdate") < F.lit(_DAY).cast("date")
    learned = Preparation(["price"], ["o_orderpriority"], scaled=True).fit(
        orders.where(old).withColumn(
            "o_orderpriority", F.when(F.col("o_orderpriority") != "3-MEDIUM", F.col("o_orderpriority"))
        )
    )
    later = learned.transform(orders.where(~old))
    return later.select("o_orderkey", F.round("price", 6).alias("price"), "o_orderpriority")


@query("scaled_forest")
def scaled_forest(spark, sf):
    """Scaler and forest in one, judged on the rows it was fitted on."""
    sales = stored(load(spark, sf, "sales").select(*CONTINUOUS, RESPONSE), "sales")
    model = models.fit_scaled_forest(sales, CONTINUOUS, RESPONSE)
    return models.accuracy(model.transform(sales), "prediction", RESPONSE)


@query(
    "knn_classify",
    """
    WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
    d AS (SELECT a.vec_id, b.label,
                 row_number() OVER (PARTITION BY a.vec_id
                                    ORDER BY list_distance(a.v, b.v), b.vec_id) AS r
          FROM e a CROSS JOIN e b)
    SELECT vec_id, label AS prediction FROM (
      SELECT vec_id, label, count(*) AS n FROM d WHERE r <= 7 GROUP BY 1, 2)
    QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY n DESC, label) = 1""",
)
def knn_classify(spark, sf):
    vectors = load(spark, sf, "embeddings")
    return neighbours.knn_classify(vectors, vectors, "vec_id", "embedding", "label", k=7)


@query(
    "knn_approximate",
    "SELECT 7 * count(*) AS n, true AS enough FROM embeddings WHERE vec_id % 20 = 0",
)
def knn_approximate(spark, sf):
    """Whether hashed projections find nine in ten of the neighbours that the exact form finds."""
    vectors = load(spark, sf, "embeddings")
    asked = vectors.where("vec_id % 20 = 0")
    found = projections.approximate_neighbours(vectors, asked, "vec_id", "embedding", "label")
    exact = neighbours.nearest_neighbours(vectors, asked, "vec_id", "embedding", "label")
    return projections.recall(found, exact).select("n", (F.col("recall") >= 0.9).alias("enough"))


_RULE = (
    SALES + ", p AS (SELECT returned AS label, CASE WHEN linestatus = 'F' THEN 1 ELSE 0 END "
    "AS prediction FROM sales) "
)


def _ruled(spark, sf):
    """Fixed predictions: a finished line counts as returned."""
    return load(spark, sf, "sales").select(
        F.col("returned").alias("label"),
        F.when(F.col("linestatus") == "F", 1).otherwise(0).alias("prediction"),
    )


@query(
    "accuracy",
    _RULE + "SELECT count(*) AS n, round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END), 6) "
    "AS accuracy FROM p",
)
def accuracy(spark, sf):
    return rounded(models.accuracy(_ruled(spark, sf), "prediction", "label"))


@query(
    "f_score",
    _RULE
    + """, c AS (SELECT k, count(CASE WHEN label = k THEN 1 END) AS support,
                        count(CASE WHEN prediction = k THEN 1 END) AS said,
                        count(CASE WHEN label = k AND prediction = k THEN 1 END) AS hit
                 FROM p CROSS JOIN (VALUES (0), (1)) v(k) GROUP BY k)
    SELECT k AS class, support, round(CAST(hit AS DOUBLE) / said, 6) AS precision,
           round(CAST(hit AS DOUBLE) / support, 6) AS recall,
           round(2 * CAST(hit AS DOUBLE) / (said + support), 6) AS f_score FROM c""",
)
def f_score(spark, sf):
    return rounded(models.f_scores(_ruled(spark, sf), "prediction", "label"))
