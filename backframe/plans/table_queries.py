"""Sources, preparation, joins and grouped aggregates as named queries."""

from __future__ import annotations

from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from backframe.functions.expressions import threshold_flag, whole_number
from backframe.operators import distribution, prepare, relational
from backframe.plans import games
from backframe.plans.registry import query
from backframe.plans.tables import CATEGORICAL, CONTINUOUS, TABLES, load, view_sql
from backframe.session import scratch_path, settings, stored
from backframe.sources import catalog, datasets, readers


def assembled_games(spark: SparkSession, sf: str) -> DataFrame:
    names = ["team_results", "batter_counts", "pitcher_counts", "game_temp", "inning_action",
             "team_streak", "team_batting_counts", "boxscore"]
    return games.game_rows(**{n: load(spark, sf, n) for n in names})


def stored_games(spark: SparkSession, sf: str) -> DataFrame:
    """The assembled games as a stored table, for windows that read them twice."""
    with settings(spark, games.CO_LOCATED):
        return stored(assembled_games(spark, sf), "game_rows")


# --- sources ---------------------------------------------------------------------------


@query(
    "scan_parquet",
    "SELECT o_orderpriority, count(*) AS n_orders, min(o_orderkey) AS first_key, "
    "max(o_orderkey) AS last_key FROM orders WHERE o_orderdate < DATE '1998-01-01' "
    "GROUP BY o_orderpriority",
)
def scan_parquet(spark, sf):
    orders = readers.require_columns(load(spark, sf, "orders"), ["o_orderkey", "o_orderdate"])
    return (
        orders.where(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
        .groupBy("o_orderpriority")
        .agg(
            F.count(F.lit(1)).alias("n_orders"),
            F.min("o_orderkey").alias("first_key"),
            F.max("o_orderkey").alias("last_key"),
        )
    )


@query(
    "scan_csv_positional",
    "SELECT l_returnflag AS flag, count(*) AS n_rows, "
    "CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS units FROM lineitem GROUP BY 1",
)
def scan_csv_positional(spark, sf):
    """The line items, written out as text without a header and read back by position."""
    path = scratch_path(spark, "positional")
    load(spark, sf, "lineitem").select(
        "l_orderkey", F.col("l_quantity").cast("bigint"), "l_returnflag"
    ).write.csv(path, header=False)
    schema = T.StructType(
        [
            T.StructField("order_id", T.LongType()),
            T.StructField("units", T.LongType()),
            T.StructField("flag", T.StringType()),
        ]
    )
    return (
        readers.read_positional_csv(spark, path, schema)
        .groupBy("flag")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.sum("units").alias("units"))
    )


datasets.register_dataset(
    "sales",
    datasets.Dataset("returned", (*CONTINUOUS, *CATEGORICAL), (prepare.drop_null_rows,)),
)


@query(
    "dataset_registry",
    view_sql("sales")
    + "SELECT returned AS response, count(*) AS n_rows, CAST(10 AS INT) AS n_predictors "
    "FROM sales GROUP BY 1",
)
def dataset_registry(spark, sf):
    data, predictors, response = datasets.load_dataset(
        "sales", lambda: load(spark, sf, "sales")
    )
    return (
        data.select(*predictors, response)
        .groupBy(F.col(response).alias("response"))
        .agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(predictors)).alias("n_predictors"))
    )


@query(
    "ctas_roundtrip",
    view_sql("team_results")
    + "SELECT team_id, count(*) AS n_games, count(CASE WHEN win_lose = 'W' THEN 1 END) AS n_won "
    "FROM team_results GROUP BY 1",
)
def ctas_roundtrip(spark, sf):
    stored = catalog.create_table_as(
        load(spark, sf, "team_results"), "backframe_team_results",
        scratch_path(spark, "team_results"),
    )
    return stored.groupBy("team_id").agg(
        F.count(F.lit(1)).alias("n_games"),
        F.count_if(F.col("win_lose") == "W").alias("n_won"),
    )


@query(
    "list_tables",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in TABLES
    ),
)
def list_tables(spark, sf):
    """The catalog's view of the given tables, with their sizes."""
    catalog.create_views({t: load(spark, sf, t) for t in TABLES})
    parts = [
        spark.table(t).agg(
            F.lit(t).alias("table_name"), F.count(F.lit(1)).alias("n_rows")
        )
        for t in catalog.table_names(spark)
        if t in TABLES
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query(
    "assert_unique",
    "SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 "
    "HAVING count(*) > 1",
)
def assert_unique(spark, sf):
    return relational.duplicate_keys(
        load(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"]
    )


# --- projections, predicates, preparation ------------------------------------------------


@query(
    "project_alias",
    "SELECT o_orderkey AS game_id, o_custkey AS entity, CAST(o_orderdate AS DATE) AS local_date "
    "FROM orders",
)
def project_alias(spark, sf):
    return load(spark, sf, "orders").select(
        F.col("o_orderkey").alias("game_id"),
        F.col("o_custkey").alias("entity"),
        F.col("o_orderdate").cast("date").alias("local_date"),
    )


@query(
    "case_label",
    view_sql("team_results")
    + "SELECT game_id, team_id, CASE WHEN home_away = 'H' AND win_lose = 'W' THEN 1 ELSE 0 END "
    "AS home_win, CASE WHEN win_lose = 'W' THEN 'won' END AS won FROM team_results",
)
def case_label(spark, sf):
    won = F.col("win_lose") == "W"
    return load(spark, sf, "team_results").select(
        "game_id",
        "team_id",
        F.when((F.col("home_away") == "H") & won, 1).otherwise(0).alias("home_win"),
        F.when(won, "won").alias("won"),
    )


@query(
    "filter_predicates",
    "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'O' "
    "AND o_orderpriority = '1-URGENT' AND CAST(o_orderdate AS DATE) BETWEEN "
    "DATE '1996-01-01' AND DATE '1996-12-31'",
)
def filter_predicates(spark, sf):
    return (
        load(spark, sf, "orders")
        .where(
            (F.col("o_orderstatus") != "O")
            & (F.col("o_orderpriority") == "1-URGENT")
            & F.col("o_orderdate").cast("date").between(F.lit("1996-01-01"), F.lit("1996-12-31"))
        )
        .select("o_orderkey", "o_orderstatus")
    )


@query(
    "filter_like",
    view_sql("inning_action", "boxscore")
    + "SELECT a.game_id, a.half, b.temp FROM inning_action a JOIN boxscore b "
    "ON a.game_id = b.game_id WHERE a.event ILIKE 'pitching substitution' "
    "AND b.temp ILIKE '%degrees'",
)
def filter_like(spark, sf):
    actions = load(spark, sf, "inning_action").where(
        F.col("event").ilike("pitching substitution")
    )
    scores = load(spark, sf, "boxscore").where(F.col("temp").ilike("%degrees"))
    return actions.join(scores, "game_id").select("game_id", "half", "temp")


@query(
    "conditional_update",
    view_sql("boxscore")
    + "SELECT game_id, CASE WHEN temp ILIKE '%degrees' THEN replace(temp, 'degrees', '') "
    "ELSE temp END AS temp FROM boxscore",
)
def conditional_update(spark, sf):
    return prepare.replace_where_like(
        load(spark, sf, "boxscore"), "temp", "%degrees", "degrees"
    )


@query(
    "parse_numeric_text",
    view_sql("boxscore")
    + "SELECT game_id, COALESCE(TRY_CAST(trim(replace(temp, 'degrees', '')) AS INT), 0) AS degrees, "
    "TRY_CAST(trim(replace(temp, 'degrees', '')) AS INT) AS degrees_clean FROM boxscore",
)
def parse_numeric_text(spark, sf):
    text = prepare.replace_where_like(
        load(spark, sf, "boxscore"), "temp", "%degrees", "degrees"
    )
    return text.select(
        "game_id",
        whole_number("temp").alias("degrees"),
        whole_number("temp", invalid=None).alias("degrees_clean"),
    )


def _quality(spark, sf):
    """Documents with their label; NULL where a document has none."""
    return load(spark, sf, "documents").select("doc_id", "lang", "n_chars").join(
        load(spark, sf, "labels"), "doc_id", "left"
    )


_QUALITY = (
    "WITH q AS (SELECT d.doc_id, d.lang, d.n_chars, l.quality, l.toxic FROM documents d "
    "LEFT JOIN labels l ON d.doc_id = l.doc_id) "
)


@query(
    "drop_nulls",
    _QUALITY + "SELECT doc_id, quality, toxic FROM q WHERE quality IS NOT NULL AND "
    "toxic IS NOT NULL AND lang IS NOT NULL AND n_chars IS NOT NULL",
)
def drop_nulls(spark, sf):
    return prepare.drop_null_rows(_quality(spark, sf)).select("doc_id", "quality", "toxic")


@query(
    "fill_zero",
    _QUALITY + "SELECT doc_id, COALESCE(quality, 0) AS quality, COALESCE(toxic, 0) AS toxic FROM q",
)
def fill_zero(spark, sf):
    return prepare.fill_zero(_quality(spark, sf), ["quality", "toxic"]).select(
        "doc_id", "quality", "toxic"
    )


@query(
    "impute_mean",
    _QUALITY + "SELECT doc_id, round(COALESCE(quality, (SELECT avg(quality) FROM q)), 6) AS quality, "
    "round(COALESCE(toxic, (SELECT avg(toxic) FROM q)), 6) AS toxic FROM q",
)
def impute_mean(spark, sf):
    filled = prepare.impute_mean(_quality(spark, sf), ["quality", "toxic"])
    return filled.select(
        "doc_id", F.round("quality", 6).alias("quality"), F.round("toxic", 6).alias("toxic")
    )


@query(
    "classify_columns",
    view_sql("sales")
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", '{kind}' AS kind, count({c}) AS n_values FROM sales"
        for kind, names in (("continuous", CONTINUOUS), ("categorical", CATEGORICAL))
        for c in names
    ),
)
def classify_columns(spark, sf):
    return prepare.column_kinds(load(spark, sf, "sales"), "returned")


_KINDS = [("returned", "sales"), ("quantity", "sales"), ("quality", "q")]


@query(
    "classify_response",
    view_sql("sales")
    + ", "
    + _QUALITY.removeprefix("WITH ")
    + " UNION ALL ".join(
        f"SELECT '{c}' AS response, CASE WHEN count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL "
        f"THEN 1 ELSE 0 END) = 2 THEN 'categorical' ELSE 'continuous' END AS kind, "
        f"count(*) - count({c}) AS n_missing FROM {source}"
        for c, source in _KINDS
    ),
)
def classify_response(spark, sf):
    sources = {"sales": load(spark, sf, "sales"), "q": _quality(spark, sf)}
    parts = [prepare.response_kind(sources[s], c) for c, s in _KINDS]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "strtobool_label",
    "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS label, "
    "CASE WHEN o_totalprice > 200000 THEN 'True' ELSE 'False' END AS large FROM orders",
)
def strtobool_label(spark, sf):
    answers = load(spark, sf, "orders").withColumn(
        "done", F.when(F.col("o_orderstatus") == "F", "yes").otherwise("no")
    )
    return prepare.binary_response(answers, "done", alias="label").select(
        "o_orderkey",
        "label",
        threshold_flag(F.col("o_totalprice") - 200000, "True", "False").alias("large"),
    )


@query(
    "drop_duplicate_columns",
    view_sql("sales")
    + "SELECT quantity AS b, tax AS c, count(*) AS n FROM sales GROUP BY 1, 2",
)
def drop_duplicate_columns(spark, sf):
    """Quantity appears three times, as number and as whole number; the last one stays."""
    wide = load(spark, sf, "sales").select(
        F.col("quantity").alias("a"),
        F.col("quantity").cast("bigint").alias("a_whole"),
        F.col("tax").alias("c"),
        F.col("quantity").alias("b"),
    )
    kept = prepare.drop_duplicate_columns(wide)
    return kept.groupBy(*sorted(kept.columns)).agg(F.count(F.lit(1)).alias("n"))


@query(
    "sql_transformer",
    "SELECT user_id, event_type, count(*) AS n_events FROM events WHERE value > 10 GROUP BY 1, 2",
)
def sql_transformer(spark, sf):
    statement = (
        "SELECT user_id, event_type, count(*) AS n_events FROM __THIS__ "
        "WHERE value > 10 GROUP BY user_id, event_type;"
    )
    return SQLTransformer(statement=statement).transform(load(spark, sf, "events"))


# --- joins -------------------------------------------------------------------------------


@query(
    "join_enrich_date",
    view_sql("pitcher_counts", "game_temp")
    + "SELECT a.game_id, a.team_id, b.local_date, a.outsPlayed AS p_o, a.Strikeout AS p_k, "
    "a.Walk AS p_bb FROM pitcher_counts a JOIN game_temp b ON a.game_id = b.game_id "
    "WHERE a.startingPitcher = 1",
)
def join_enrich_date(spark, sf):
    return games.starters(load(spark, sf, "pitcher_counts"), load(spark, sf, "game_temp"))


@query(
    "join_two_key",
    view_sql("battersInGame", "game", "batter_counts")
    + "SELECT c.game_id, c.batter, c.Hit, c.atBat, g.local_date FROM battersInGame b "
    "JOIN batter_counts c ON b.game_id = c.game_id AND b.batter = c.batter "
    "JOIN game g ON g.game_id = b.game_id",
)
def join_two_key(spark, sf):
    return _batter_games(spark, sf)


def _batter_games(spark, sf):
    return games.batter_games(
        load(spark, sf, "battersInGame"), load(spark, sf, "game"),
        load(spark, sf, "batter_counts"),
    )


@query(
    "pair_opponents",
    view_sql("team_results")
    + "SELECT a.game_id, a.local_date, a.team_id AS h_team, b.team_id AS a_team, "
    "CASE WHEN a.win_lose = 'W' THEN 1 ELSE 0 END AS hometeam_win FROM team_results a "
    "JOIN team_results b ON a.game_id = b.game_id WHERE a.team_id <> b.team_id "
    "AND a.home_away = 'H'",
)
def pair_opponents(spark, sf):
    return games.opponents(load(spark, sf, "team_results"))


BOX_SQL = "SELECT game_id, team_id, " + ", ".join(
    f"CAST(sum(b.{'\"Double\"' if column == 'Double' else column}) AS BIGINT) AS {name}"
    for column, name in games.BATTING.items()
) + " FROM batter_counts b GROUP BY game_id, team_id"

_SIDE = ["h", "ab", "hr", "singles", "doubles", "triples", "sf", "bb", "g", "f", "k", "plate",
         "hbp", "sh"]

GAME_ROW_CTES = (
    view_sql("team_results", "batter_counts", "pitcher_counts", "game_temp", "inning_action",
             "team_streak", "team_batting_counts", "boxscore")
    + f""", box AS ({BOX_SQL}),
    starter AS (SELECT p.game_id, p.team_id, p.outsPlayed AS p_o, p.Strikeout AS p_k,
                       p.Walk AS p_bb
                FROM pitcher_counts p JOIN game_temp t ON p.game_id = t.game_id
                WHERE p.startingPitcher = 1),
    subs AS (SELECT game_id, count(CASE WHEN half = 0 THEN 1 END) AS n0,
                    count(CASE WHEN half = 1 THEN 1 END) AS n1
             FROM inning_action WHERE event = 'Pitching Substitution' GROUP BY game_id),
    moved AS (SELECT game_id, team_id,
                     CAST(CASE win_lose WHEN 'W' THEN sum(streak) - 1 WHEN 'L' THEN sum(streak) + 1
                          END AS BIGINT) AS streak
              FROM team_streak GROUP BY team_streak_id, game_id, team_id, win_lose),
    game_rows AS (
      SELECT x.game_id, x.local_date, x.team_id AS h_team, y.team_id AS a_team,
             CASE WHEN x.win_lose = 'W' THEN 1 ELSE 0 END AS hometeam_win,
             {", ".join(f"hb.{c} AS home_{c}, ab.{c} AS away_{c}" for c in _SIDE)},
             {", ".join(f"hp.{c} AS home_{c}, ap.{c} AS away_{c}" for c in ("p_o", "p_k", "p_bb"))},
             hf.finalScore AS home_finalscore, af.finalScore AS away_finalscore,
             NULLIF(u.n0, 0) AS home_sub, NULLIF(u.n1, 0) AS away_sub,
             hs.streak AS home_streak, aws.streak AS away_streak,
             CASE WHEN w.temp LIKE '%degrees' THEN replace(w.temp, 'degrees', '') ELSE w.temp
             END AS temp
      FROM team_results x
      JOIN team_results y ON x.game_id = y.game_id AND x.team_id <> y.team_id
      JOIN box hb ON hb.game_id = x.game_id AND hb.team_id = x.team_id
      JOIN box ab ON ab.game_id = x.game_id AND ab.team_id = y.team_id
      JOIN starter hp ON hp.game_id = x.game_id AND hp.team_id = x.team_id
      JOIN starter ap ON ap.game_id = x.game_id AND ap.team_id = y.team_id
      JOIN team_batting_counts hf ON hf.game_id = x.game_id AND hf.team_id = x.team_id
      JOIN team_batting_counts af ON af.game_id = x.game_id AND af.team_id = y.team_id
      JOIN subs u ON u.game_id = x.game_id
      JOIN moved hs ON hs.game_id = x.game_id AND hs.team_id = x.team_id
      JOIN moved aws ON aws.game_id = x.game_id AND aws.team_id = y.team_id
      JOIN boxscore w ON w.game_id = x.game_id
      WHERE x.home_away = 'H')
    """
)


@query("assemble_game_row", GAME_ROW_CTES + "SELECT * FROM game_rows")
def assemble_game_row(spark, sf):
    return assembled_games(spark, sf)


# --- grouped aggregates --------------------------------------------------------------------


@query("box_totals", view_sql("batter_counts") + BOX_SQL)
def box_totals(spark, sf):
    return games.box_totals(load(spark, sf, "batter_counts"))


@query(
    "event_count_by_half",
    view_sql("inning_action")
    + "SELECT game_id, half, count(*) AS n_events FROM inning_action "
    "WHERE event = 'Pitching Substitution' GROUP BY 1, 2",
)
def event_count_by_half(spark, sf):
    return games.event_counts(load(spark, sf, "inning_action"))


@query(
    "pivot_halves",
    view_sql("inning_action")
    + ", c AS (SELECT game_id, half, count(*) AS n FROM inning_action "
    "WHERE event = 'Pitching Substitution' GROUP BY 1, 2) SELECT game_id, "
    "max(CASE WHEN half = 0 THEN n END) AS home_sub, max(CASE WHEN half = 1 THEN n END) AS away_sub "
    "FROM c GROUP BY 1",
)
def pivot_halves(spark, sf):
    return games.substitutions(load(spark, sf, "inning_action"))


@query(
    "historical_ratio",
    view_sql("batter_counts")
    + "SELECT batter, round(CASE WHEN sum(atBat) = 0 THEN 0 ELSE CAST(sum(Hit) AS DOUBLE) / "
    "CAST(sum(atBat) AS DOUBLE) END, 6) AS batting_average FROM batter_counts GROUP BY batter",
)
def historical_ratio(spark, sf):
    averages = games.career_average(load(spark, sf, "batter_counts"))
    return averages.select("batter", F.round("batting_average", 6).alias("batting_average"))


@query(
    "annual_ratio",
    view_sql("battersInGame", "game", "batter_counts")
    + "SELECT c.batter, CAST(year(g.local_date) AS INT) AS year, round(CASE WHEN sum(c.atBat) = 0 "
    "THEN 0 ELSE CAST(sum(c.Hit) AS DOUBLE) / CAST(sum(c.atBat) AS DOUBLE) END, 6) "
    "AS batting_average FROM battersInGame b JOIN game g ON b.game_id = g.game_id "
    "JOIN batter_counts c ON b.batter = c.batter AND b.game_id = c.game_id GROUP BY 1, 2",
)
def annual_ratio(spark, sf):
    averages = games.annual_average(_batter_games(spark, sf))
    return averages.select(
        "batter", "year", F.round("batting_average", 6).alias("batting_average")
    )


@query(
    "streak_adjust",
    view_sql("team_streak")
    + "SELECT game_id, team_id, CAST(CASE win_lose WHEN 'W' THEN sum(streak) - 1 "
    "WHEN 'L' THEN sum(streak) + 1 END AS BIGINT) AS streak FROM team_streak "
    "GROUP BY team_streak_id, game_id, team_id, win_lose",
)
def streak_adjust(spark, sf):
    return games.current_streaks(load(spark, sf, "team_streak"))


@query(
    "summary_stats",
    view_sql("sales")
    + " UNION ALL ".join(
        f"SELECT '{c}' AS name, round(avg({c}), 9) AS mean, min({c}) AS min, max({c}) AS max, "
        f"round(quantile_cont({c}, 0.5), 6) AS median FROM sales"
        for c in CONTINUOUS
    ),
)
def summary_stats(spark, sf):
    summary = distribution.column_summary(load(spark, sf, "sales"), CONTINUOUS)
    return summary.select(
        "name", F.round("mean", 9).alias("mean"), "min", "max",
        F.round("median", 6).alias("median"),
    )


@query(
    "contingency",
    view_sql("sales")
    + """, t AS (SELECT orderpriority AS x, CASE WHEN returned > 0 THEN 'True' ELSE 'False' END AS y
                 FROM sales),
    labels AS (SELECT x AS l FROM t UNION SELECT y FROM t)
    SELECT a.l AS x, b.l AS y, count(t.x) AS n FROM labels a CROSS JOIN labels b
    LEFT JOIN t ON t.x = a.l AND t.y = b.l GROUP BY 1, 2""",
)
def contingency(spark, sf):
    flagged = load(spark, sf, "sales").withColumn(
        "answer", threshold_flag("returned", "True", "False")
    )
    return relational.contingency(flagged, "orderpriority", "answer")


@query(
    "distinct_keys",
    "SELECT l_returnflag, l_linestatus, count(DISTINCT l_suppkey) AS n_suppliers "
    "FROM lineitem GROUP BY 1, 2",
)
def distinct_keys(spark, sf):
    return (
        load(spark, sf, "lineitem")
        .select("l_returnflag", "l_linestatus", "l_suppkey")
        .distinct()
        .groupBy("l_returnflag", "l_linestatus")
        .agg(F.count("l_suppkey").alias("n_suppliers"))
    )


@query(
    "pivot_matrix",
    view_sql("sales")
    + "SELECT orderpriority, count(CASE WHEN returnflag = 'A' THEN 1 END) AS A, "
    "count(CASE WHEN returnflag = 'N' THEN 1 END) AS N, "
    "count(CASE WHEN returnflag = 'R' THEN 1 END) AS R FROM sales GROUP BY 1",
)
def pivot_matrix(spark, sf):
    cells = relational.observed_cells(load(spark, sf, "sales"), "orderpriority", "returnflag")
    return relational.wide_form(
        cells.withColumnRenamed("x", "orderpriority"), "orderpriority", "y", "n", ["A", "N", "R"]
    )


@query(
    "unpivot_long",
    "SELECT doc_id, 'quality' AS name, quality AS value FROM labels WHERE quality IS NOT NULL "
    "UNION ALL SELECT doc_id, 'toxic', toxic FROM labels WHERE toxic IS NOT NULL",
)
def unpivot_long(spark, sf):
    return relational.long_form(load(spark, sf, "labels"), ["doc_id"], ["quality", "toxic"])


@query(
    "sort_rows",
    "SELECT game_id, local_date FROM (SELECT o_orderkey AS game_id, CAST(o_orderdate AS DATE) "
    "AS local_date FROM orders) ORDER BY local_date, game_id",
)
def sort_rows(spark, sf):
    return load(spark, sf, "game").orderBy("local_date", "game_id")
