"""The given tables, and game-shaped views derived from them.

The views are plain integer SQL, so that the same text defines them in Spark and in the
checking engine; ``{name}`` stands for another table or view.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
)

VIEWS = {
    "games": """
        SELECT o_orderkey AS game_id, CAST(o_orderdate AS DATE) AS local_date,
               o_custkey % 10 AS h_team, (o_custkey % 10 + 1 + o_orderkey % 9) % 10 AS a_team,
               o_custkey AS seed, o_orderstatus AS status
        FROM {orders}""",
    "game": "SELECT game_id, local_date FROM {games}",
    "game_temp": "SELECT game_id, local_date FROM {games}",
    "team_results": """
        SELECT game_id, h_team AS team_id, local_date, 'H' AS home_away,
               CASE WHEN status = 'F' THEN 'W' ELSE 'L' END AS win_lose, seed
        FROM {games}
        UNION ALL
        SELECT game_id, a_team AS team_id, local_date, 'A' AS home_away,
               CASE WHEN status = 'F' THEN 'L' ELSE 'W' END AS win_lose, seed
        FROM {games}""",
    "batter_counts": """
        SELECT g.game_id,
               CASE WHEN l.l_linenumber % 2 = 1 THEN g.h_team ELSE g.a_team END AS team_id,
               l.l_partkey % 200 AS batter,
               CAST(l.l_quantity AS INT) AS atBat,
               CAST(l.l_quantity AS INT) % 7 AS Hit,
               CAST(l.l_quantity AS INT) % 4 AS Single,
               CAST(l.l_quantity AS INT) % 3 AS `Double`,
               l.l_linenumber % 2 AS Triple,
               l.l_suppkey % 2 AS Home_Run,
               l.l_partkey % 3 AS Walk,
               l.l_partkey % 4 AS Strikeout,
               l.l_linenumber % 2 AS Intent_Walk,
               CAST(l.l_quantity AS INT) + l.l_partkey % 3 AS plateApperance,
               l.l_suppkey % 3 AS Sac_Fly,
               CAST(l.l_quantity AS INT) % 5 AS Ground_Out,
               CAST(l.l_quantity AS INT) % 6 AS Fly_Out,
               l.l_linenumber % 3 AS Hit_By_Pitch,
               l.l_linenumber % 4 AS Sac_Bunt
        FROM {lineitem} l JOIN {games} g ON l.l_orderkey = g.game_id""",
    "battersInGame": "SELECT DISTINCT game_id, batter FROM {batter_counts}",
    "pitcher_counts": """
        SELECT game_id, team_id, 1 AS startingPitcher,
               9 + (game_id + team_id) % 18 AS outsPlayed,
               (seed + team_id) % 9 AS Strikeout, seed % 4 AS Walk
        FROM {team_results}
        UNION ALL
        SELECT game_id, h_team AS team_id, 0 AS startingPitcher,
               CAST(3 AS BIGINT) AS outsPlayed, CAST(1 AS BIGINT) AS Strikeout,
               CAST(1 AS BIGINT) AS Walk
        FROM {games}""",
    "team_batting_counts": """
        SELECT game_id, team_id, (game_id + team_id) % 12 AS finalScore FROM {team_results}""",
    "inning_action": """
        SELECT l_orderkey AS game_id, l_linenumber % 2 AS half,
               CASE l_returnflag WHEN 'R' THEN 'Pitching Substitution' WHEN 'A' THEN 'Single'
                    ELSE 'Strikeout' END AS event
        FROM {lineitem}""",
    "boxscore": """
        SELECT game_id, CASE WHEN game_id % 17 = 0 THEN 'unknown'
                             ELSE CONCAT(CAST(50 + game_id % 45 AS VARCHAR(9)), ' degrees')
                        END AS temp
        FROM {games}""",
    "team_streak": """
        SELECT 2 * game_id + CASE WHEN home_away = 'A' THEN 1 ELSE 0 END AS team_streak_id,
               game_id, team_id, win_lose,
               CASE WHEN win_lose = 'W' THEN 1 + seed % 6 ELSE -(1 + seed % 6) END AS streak
        FROM {team_results}""",
    # One line item with its order and part: the frame the feature analysis runs on.
    "sales": """
        SELECT l.l_quantity AS quantity, l.l_extendedprice AS extendedprice,
               l.l_discount AS discount, l.l_tax AS tax, p.p_retailprice AS retailprice,
               CAST(p.p_size AS DOUBLE) AS part_size,
               l.l_returnflag AS returnflag, l.l_linestatus AS linestatus,
               o.o_orderpriority AS orderpriority, p.p_brand AS brand,
               CASE WHEN l.l_returnflag = 'R' THEN 1 ELSE 0 END AS returned
        FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey
        JOIN {part} p ON l.l_partkey = p.p_partkey""",
}

CONTINUOUS = ["quantity", "extendedprice", "discount", "tax", "retailprice", "part_size"]
CATEGORICAL = ["returnflag", "linestatus", "orderpriority", "brand"]

_PLACEHOLDER = re.compile(r"\{(\w+)\}")


_FRAMES: dict[tuple[str, str, str], DataFrame] = {}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table or a derived view as a DataFrame; only the plan is kept, no data."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _FRAMES:
        if name in TABLES:
            _FRAMES[key] = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        else:
            text = VIEWS[name]
            inputs = {
                n: load(spark, sf_dir, n) for n in dict.fromkeys(_PLACEHOLDER.findall(text))
            }
            _FRAMES[key] = spark.sql(text, **inputs)
    return _FRAMES[key]


def view_sql(*names: str) -> str:
    """A WITH clause defining the named views, and those they need, for the checks."""
    ordered: dict[str, str] = {}

    def visit(name: str) -> None:
        if name in TABLES or name in ordered:
            return
        for needed in _PLACEHOLDER.findall(VIEWS[name]):
            visit(needed)
        ordered[name] = _PLACEHOLDER.sub(r"\1", VIEWS[name]).replace("`", '"')

    for name in names:
        visit(name)
    return "WITH " + ",\n".join(f"{n} AS ({text})" for n, text in ordered.items())
