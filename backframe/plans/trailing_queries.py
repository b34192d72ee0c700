"""Trailing windows, streaks and the ordered split as named queries."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from backframe.functions.expressions import whole_number
from backframe.operators import split, streaks, trailing
from backframe.operators.prepare import replace_where_like
from backframe.plans import games
from backframe.plans.registry import query
from backframe.plans.table_queries import GAME_ROW_CTES, _batter_games, stored_games
from backframe.plans.tables import load, view_sql
from backframe.session import stored


def _finished_orders(spark, sf):
    """Orders per customer and date; 'hits' are finished orders."""
    return load(spark, sf, "orders").select(
        "o_orderkey",
        "o_custkey",
        F.col("o_orderdate").cast("date").alias("day"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("finished"),
        F.lit(1).alias("placed"),
    )


@query(
    "rolling_ratio_100d",
    """
    WITH o AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS day,
                      CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS finished FROM orders)
    SELECT a.o_orderkey, a.o_custkey, a.day, count(*) AS n_matches,
           round(CAST(sum(b.finished) AS DOUBLE) / CAST(count(*) AS DOUBLE), 6) AS finished_share
    FROM o a JOIN o b ON a.o_custkey = b.o_custkey
     AND b.day BETWEEN a.day - 100 AND a.day - 1
    GROUP BY 1, 2, 3""",
)
def rolling_ratio_100d(spark, sf):
    out = trailing.trailing_ratio(
        _finished_orders(spark, sf), ["o_custkey"], "day", "finished", "placed", 100,
        alias="share", carry=["o_orderkey", "o_custkey", "day"],
    )
    return out.select(
        "o_orderkey", "o_custkey", "day", "n_matches", F.round("share", 6).alias("finished_share")
    )


@query(
    "rolling_batting_average",
    view_sql("battersInGame", "game", "batter_counts")
    + """, t AS (SELECT c.game_id, c.batter, c.Hit, c.atBat, g.local_date
            FROM battersInGame b
            JOIN batter_counts c ON b.game_id = c.game_id AND b.batter = c.batter
            JOIN game g ON g.game_id = b.game_id)
    SELECT a.game_id, a.batter, a.local_date,
           round(CASE WHEN sum(b.atBat) = 0 THEN 0
                      ELSE CAST(sum(b.Hit) AS DOUBLE) / CAST(sum(b.atBat) AS DOUBLE) END, 6)
           AS rolling_batting
    FROM t a JOIN t b ON a.batter = b.batter
     AND b.local_date BETWEEN a.local_date - 100 AND a.local_date - 1
    GROUP BY 1, 2, 3""",
)
def rolling_batting_average(spark, sf):
    out = games.rolling_average(stored(_batter_games(spark, sf), "batter_games"))
    return out.withColumn("rolling_batting", F.round("rolling_batting", 6))


@query(
    "rolling_ratio_exact_hours",
    """
    SELECT a.event_id, count(*) AS n_matches,
           round(CASE WHEN sum(CAST(round(b.value * 100) AS BIGINT)) = 0 THEN 0
                 ELSE CAST(sum(CASE WHEN b.event_type = 'purchase'
                                    THEN CAST(round(b.value * 100) AS BIGINT) ELSE 0 END) AS DOUBLE)
                 / CAST(sum(CAST(round(b.value * 100) AS BIGINT)) AS DOUBLE) END, 6) AS share
    FROM events a JOIN events b ON a.user_id = b.user_id
     AND b.ts BETWEEN a.ts - INTERVAL 7 DAY AND a.ts - INTERVAL 1 DAY
    GROUP BY 1""",
)
def rolling_ratio_exact_hours(spark, sf):
    cents = F.round(F.col("value") * 100).cast("bigint")
    bought = F.when(F.col("event_type") == "purchase", cents).otherwise(0)
    out = trailing.trailing_ratio(
        load(spark, sf, "events"), ["user_id"], "ts", bought, cents, 7,
        alias="share", unit="timestamp", carry=["event_id"],
    )
    return out.select("event_id", "n_matches", F.round("share", 6).alias("share"))


@query(
    "band_self_join",
    """
    SELECT a.event_id, count(*) AS n_matches,
           CAST(sum(CAST(round(b.value * 100) AS BIGINT)) AS BIGINT) AS cents
    FROM events a JOIN events b ON a.user_id = b.user_id
     AND CAST(b.ts AS DATE) BETWEEN CAST(a.ts AS DATE) - 7 AND CAST(a.ts AS DATE) - 1
    GROUP BY 1""",
)
def band_self_join(spark, sf):
    return trailing.band_self_join(
        load(spark, sf, "events"), ["user_id"], "ts",
        {"cents": F.round(F.col("value") * 100).cast("bigint")}, 7, carry=["event_id"],
    )


_DAILY = (
    "WITH e AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n, "
    "sum(CAST(round(value * 100) AS BIGINT)) AS cents FROM events GROUP BY 1) "
)


@query(
    "rolling_global",
    _DAILY + """, w AS (SELECT a.day, sum(b.n) AS n_matches, sum(b.cents) AS cents
    FROM e a JOIN e b ON b.day BETWEEN a.day - 7 AND a.day - 1 GROUP BY 1)
    SELECT event_id, CAST(n_matches AS BIGINT) AS n_matches, CAST(cents AS BIGINT) AS cents
    FROM events JOIN w ON CAST(ts AS DATE) = day""",
)
def rolling_global(spark, sf):
    return trailing.with_trailing_totals(
        load(spark, sf, "events"), [], "ts",
        {"cents": F.round(F.col("value") * 100).cast("bigint")}, 7, carry=["event_id"],
    )


_TEAM = 3
_SHORT = ["h", "ab", "hr", "singles", "doubles", "triples"]


def _team_sql(side: str, letter: str) -> str:
    s = {c: f"sum(b.{side}_{c})" for c in [*_SHORT, "p_o", "p_k", "p_bb"]}

    def over(top: str, bottom: str, guard: str) -> str:
        return (
            f"round(CASE WHEN {guard} = 0 THEN 0 ELSE CAST({top} AS DOUBLE) / "
            f"CAST(NULLIF({bottom}, 0) AS DOUBLE) END, 6)"
        )

    bases = f"{s['singles']} + 2 * {s['doubles']} + 3 * {s['triples']} + 4 * {s['hr']}"
    return f"""
        {over(s['h'], s['ab'], s['ab'])} AS {letter}_batting_avg,
        {over(s['hr'], s['h'], s['hr'])} AS {letter}_home_run_per_hit,
        {over(f'({bases})', s['ab'], s['ab'])} AS {letter}_slugging_avg,
        round(CAST({s['p_o']} AS DOUBLE) / 3, 6) AS {letter}_ip,
        {over(s['p_k'], s['p_bb'], s['p_bb'])} AS {letter}_strike_to_walk"""


@query(
    "rolling_global_100d",
    GAME_ROW_CTES
    + f""", mine AS (
      SELECT x.game_id, x.local_date,
             CASE WHEN x.home_away = 'H' AND x.win_lose = 'W' THEN 1 ELSE 0 END AS hometeam_win,
             {", ".join(f"hb.{c} AS home_{c}, ab.{c} AS away_{c}" for c in _SHORT)},
             {", ".join(f"hp.{c} AS home_{c}, ap.{c} AS away_{c}" for c in ("p_o", "p_k", "p_bb"))}
      FROM team_results x
      JOIN team_results y ON x.game_id = y.game_id AND x.team_id <> y.team_id
      JOIN box hb ON hb.game_id = x.game_id AND hb.team_id = x.team_id
      JOIN box ab ON ab.game_id = x.game_id AND ab.team_id = y.team_id
      JOIN starter hp ON hp.game_id = x.game_id AND hp.team_id = x.team_id
      JOIN starter ap ON ap.game_id = x.game_id AND ap.team_id = y.team_id
      WHERE x.team_id = {_TEAM})
    SELECT a.game_id, a.local_date, {_team_sql("home", "h")}, {_team_sql("away", "a")},
           a.hometeam_win
    FROM mine a JOIN mine b ON b.local_date BETWEEN a.local_date - 100 AND a.local_date - 1
    GROUP BY a.game_id, a.local_date, a.hometeam_win""",
)
def rolling_global_100d(spark, sf):
    own = games.team_games(
        *[load(spark, sf, n)
          for n in ("team_results", "batter_counts", "pitcher_counts", "game_temp")],
        team=_TEAM,
    )
    return _rounded(games.team_features(stored(own, "team_games")))


def _rounded(df, digits=6):
    return df.select(
        *[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    )


def _pair_sql(side: str, p: str) -> str:
    def s(name: str) -> str:
        return f"sum(b.{side}_{name})"

    def over(top: str, bottom: str, guard: str | None = None) -> str:
        return (
            f"round(CASE WHEN {guard or bottom} = 0 THEN 0 ELSE CAST({top} AS DOUBLE) / "
            f"CAST(NULLIF({bottom}, 0) AS DOUBLE) END, 6)"
        )

    def whole(text: str) -> str:
        return f"CAST({text} AS BIGINT)"

    h, ab, hr, bb, k, sf = (s(n) for n in ("h", "ab", "hr", "bb", "k", "sf"))
    b1, b2, b3, hbp = (s(n) for n in ("singles", "doubles", "triples", "hbp"))
    tb = f"({h} + {b2} + 2 * {b3} + 3 * {hr})"
    xbh = f"({b2} + {b3} + {hr})"
    play = f"({ab} - {k} - {hr} + {sf})"
    base = f"({h} + {bb} + {hbp})"
    slug = over(f"({b1} + 2 * {b2} + 3 * {b3} + 4 * {hr})", ab)
    adv = (
        f"(CAST(1.4 AS DOUBLE) * {tb} - CAST(0.6 AS DOUBLE) * {h} - 3 * {hr} "
        f"+ CAST(0.1 AS DOUBLE) * {bb} * CAST(1.02 AS DOUBLE))"
    )
    features = {
        "1b": whole(b1),
        "2b": whole(b2),
        "3b": whole(b3),
        "ab": whole(ab),
        "at_bats_per_homerun": over(ab, hr),
        "batting_avg": over(h, ab, h),
        "bb": whole(bb),
        "babip": over(f"({ab} - {hr})", play, h if side == "home" else play),
        "walk2strikeout_ratio": over(bb, k),
        "baserun": (
            f"round(CASE WHEN {adv} + ({ab} - {h}) = 0 THEN CAST({hr} AS DOUBLE) ELSE "
            f"({h} + {bb} - {hr}) * {adv} / ({adv} + ({ab} - {h})) + {hr} END, 6)"
        ),
        "tb": whole(tb),
        "groundfly_ratio": over(s("g"), s("f")),
        "xbh": whole(xbh),
        "plate": whole(s("plate")),
        "strikeout": whole(k),
        "strike_to_walk": over(k, bb),
        "slugging_avg": slug,
        "tob": whole(base),
        "sf": whole(sf),
        "slugging_percentage": slug,
        "on_base_percentage": over(base, f"({ab} + {bb} + {hbp} + {sf})"),
        "plate_per_strike": over(s("plate"), k),
        "iso": over(xbh, ab),
        "finalscore": whole(s("finalscore")),
        "p_strike_to_walk": over(s("p_k"), s("p_bb")),
        "p_ip": f"round(CAST({s('p_o')} AS DOUBLE) / 3, 6)",
    }
    return ", ".join(f"{text} AS {p}_{name}" for name, text in features.items())


PAIR_FEATURES_SQL = (
    GAME_ROW_CTES
    + f""", pair_features AS (
    SELECT a.game_id, a.local_date, a.h_team, a.a_team,
           {_pair_sql("home", "h")}, {_pair_sql("away", "a")},
           CAST(sum(b.home_sub) AS BIGINT) AS home_pitch_substute,
           CAST(sum(b.away_sub) AS BIGINT) AS away_pitch_substute,
           CAST(sum(b.home_sub) - sum(b.away_sub) AS BIGINT) AS pitch_substract,
           CAST(sum(b.home_doubles) + sum(b.home_triples) + sum(b.home_hr)
                - sum(b.away_doubles) - sum(b.away_triples) - sum(b.away_hr) AS BIGINT) AS diff_xbh,
           a.home_streak, a.away_streak,
           round(avg(COALESCE(TRY_CAST(trim(b.temp) AS INT), 0)), 6) AS avg_temp,
           trim(a.temp) AS temp, a.hometeam_win
    FROM game_rows a JOIN game_rows b ON a.h_team = b.h_team AND a.a_team = b.a_team
     AND b.local_date BETWEEN a.local_date - 7 AND a.local_date - 1
    GROUP BY a.game_id, a.local_date, a.h_team, a.a_team, a.home_streak, a.away_streak, a.temp,
             a.hometeam_win)
    """
)


@query("rolling_pair_features", PAIR_FEATURES_SQL + "SELECT * FROM pair_features")
def rolling_pair_features(spark, sf):
    return _rounded(games.pair_features(stored_games(spark, sf)))


# Every feature of both sides but the one whose difference the rows have already.
_DIFFS = [n for n in re.findall(r" AS h_(\w+)", _pair_sql("home", "h")) if n != "xbh"]


@query(
    "diff_features",
    PAIR_FEATURES_SQL
    + "SELECT game_id, "
    + ", ".join(f"round(h_{n} - a_{n}, 6) AS diff_{n}" for n in _DIFFS)
    + " FROM pair_features",
)
def diff_features(spark, sf):
    features = games.difference_features(
        _rounded(games.pair_features(stored_games(spark, sf)))
    )
    return _rounded(features.select("game_id", *[f"diff_{n}" for n in _DIFFS]))


@query(
    "rolling_mean_10d",
    view_sql("games", "boxscore")
    + """, t AS (SELECT g.game_id, g.h_team, g.local_date,
                        COALESCE(TRY_CAST(trim(replace(x.temp, 'degrees', '')) AS INT), 0) AS degrees
                 FROM games g JOIN boxscore x ON g.game_id = x.game_id)
    SELECT a.game_id, a.h_team, a.local_date, count(*) AS n_matches,
           round(CAST(sum(b.degrees) AS DOUBLE) / count(*), 6) AS mean_temp
    FROM t a JOIN t b ON a.h_team = b.h_team
     AND b.local_date BETWEEN a.local_date - 10 AND a.local_date - 1
    GROUP BY 1, 2, 3""",
)
def rolling_mean_10d(spark, sf):
    temps = replace_where_like(load(spark, sf, "boxscore"), "temp", "%degrees", "degrees")
    dated = load(spark, sf, "games").join(temps, "game_id")
    out = trailing.trailing_mean(
        dated, ["h_team"], "local_date", whole_number("temp"), 10, alias="mean_temp",
        carry=["game_id", "h_team", "local_date"],
    )
    return _rounded(out)


_RESULTS = """
    WITH r AS (SELECT o_orderkey AS game_id, o_custkey AS team_id,
                      CAST(o_orderdate AS DATE) AS local_date,
                      CASE WHEN o_orderstatus = 'F' THEN 'W' ELSE 'L' END AS win_lose FROM orders),
    s AS (SELECT a.game_id, a.team_id, a.local_date, a.win_lose,
                 (SELECT count(*) FROM r b
                  WHERE b.win_lose = a.win_lose AND b.team_id = a.team_id
                    AND b.local_date < a.local_date
                    AND NOT EXISTS (SELECT 1 FROM r c
                                    WHERE c.team_id = a.team_id AND c.win_lose <> b.win_lose
                                      AND c.local_date BETWEEN b.local_date AND a.local_date))
                 AS streak
          FROM r a)
    """


def _results(spark, sf):
    return load(spark, sf, "orders").select(
        F.col("o_orderkey").alias("game_id"),
        F.col("o_custkey").alias("team_id"),
        F.col("o_orderdate").cast("date").alias("local_date"),
        F.when(F.col("o_orderstatus") == "F", "W").otherwise("L").alias("win_lose"),
    )


@query("streak_parity", _RESULTS + "SELECT game_id, team_id, streak FROM s")
def streak_parity(spark, sf):
    return streaks.streaks(_results(spark, sf)).select("game_id", "team_id", "streak")


@query(
    "streak_signed",
    _RESULTS + "SELECT game_id, CASE WHEN win_lose = 'L' THEN -streak ELSE streak END "
    "AS signed_streak FROM s",
)
def streak_signed(spark, sf):
    return streaks.streaks(_results(spark, sf)).select("game_id", "signed_streak")


@query(
    "streak_entering",
    _RESULTS
    + """SELECT game_id, team_id, COALESCE(lag(CASE WHEN win_lose = 'L' THEN -streak - 1
                                               ELSE streak + 1 END)
                OVER (PARTITION BY team_id ORDER BY local_date, game_id), 0) AS streak_entering
         FROM s""",
)
def streak_entering(spark, sf):
    return streaks.streak_entering(_results(spark, sf)).select(
        "game_id", "team_id", "streak_entering"
    )


@query(
    "ordered_split",
    """
    WITH n AS (SELECT CAST(ceil(count(*) * CAST(0.33 AS DOUBLE)) AS BIGINT) AS k FROM orders),
    o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day,
                 row_number() OVER (ORDER BY CAST(o_orderdate AS DATE) DESC, o_orderkey DESC) AS r
          FROM orders)
    SELECT o_orderkey, r <= k AS is_test FROM o CROSS JOIN n""",
)
def ordered_split(spark, sf):
    days = load(spark, sf, "orders").select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("day")
    )
    return split.ordered_split(days, "day", "o_orderkey").select("o_orderkey", "is_test")
