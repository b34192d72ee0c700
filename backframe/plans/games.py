"""From raw game tables to one feature row per game."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from backframe.functions.expressions import ratio, whole_number
from backframe.operators.prepare import replace_where_like
from backframe.operators.relational import grouped_ratio, pair_rows, pivot_flag
from backframe.operators.streaks import adjusted_streaks
from backframe.operators.trailing import trailing_ratio, with_trailing_totals
from backframe.session import settings

# Batting columns of the input, and the short names of their team totals.
BATTING = {
    "Hit": "h",
    "atBat": "ab",
    "Walk": "bb",
    "Home_Run": "hr",
    "Strikeout": "k",
    "Intent_Walk": "iw",
    "plateApperance": "plate",
    "Single": "singles",
    "Double": "doubles",
    "Triple": "triples",
    "Sac_Fly": "sf",
    "Ground_Out": "g",
    "Fly_Out": "f",
    "Hit_By_Pitch": "hbp",
    "Sac_Bunt": "sh",
}
SUBSTITUTION = "Pitching Substitution"

#: Rows that lie together by game need no other place to meet by game and team.
CO_LOCATED = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}

_LINE = ["h", "ab", "hr", "singles", "doubles", "triples", "sf", "bb", "g", "f", "k",
         "plate", "hbp"]
_STARTER = ["p_o", "p_k", "p_bb"]


def box_totals(batter_counts: DataFrame) -> DataFrame:
    """Team batting totals per game."""
    return batter_counts.groupBy("game_id", "team_id").agg(
        *[F.sum(column).alias(name) for column, name in BATTING.items()]
    )


def starters(pitcher_counts: DataFrame, dates: DataFrame) -> DataFrame:
    """Starting pitchers' lines with the date of the game."""
    return (
        pitcher_counts.where(F.col("startingPitcher") == 1)
        .join(dates, "game_id")
        .select(
            "game_id",
            "team_id",
            "local_date",
            F.col("outsPlayed").alias("p_o"),
            F.col("Strikeout").alias("p_k"),
            F.col("Walk").alias("p_bb"),
        )
    )


def event_counts(inning_action: DataFrame, event: str = SUBSTITUTION) -> DataFrame:
    """Number of matching events per game and half inning; letter case is ignored."""
    return (
        inning_action.where(F.col("event").ilike(event))
        .groupBy("game_id", "half")
        .agg(F.count("event").alias("n_events"))
    )


def substitutions(inning_action: DataFrame) -> DataFrame:
    """Pitching substitutions per game, by side; NULL for a side without any."""
    return pivot_flag(
        event_counts(inning_action), "game_id", "half", "n_events",
        {0: "home_sub", 1: "away_sub"},
    )


def opponents(team_results: DataFrame, exactly_two: bool = False) -> DataFrame:
    """One row per game: date, home team, away team and whether the home team won."""
    games = pair_rows(
        team_results,
        "game_id",
        "team_id",
        F.col("home_away") == "H",
        {"local_date": "local_date", "h_team": "team_id", "home_result": "win_lose"},
        {"a_team": "team_id"},
        exactly_two=exactly_two,
    )
    won = F.when(F.col("home_result") == "W", 1).otherwise(0)
    return games.select(
        "game_id", "local_date", "h_team", "a_team", won.alias("hometeam_win")
    )


def current_streaks(team_streak: DataFrame) -> DataFrame:
    return adjusted_streaks(
        team_streak, "team_streak_id", ["game_id", "team_id"], "win_lose", "streak"
    )


def game_rows(
    team_results: DataFrame,
    batter_counts: DataFrame,
    pitcher_counts: DataFrame,
    game_temp: DataFrame,
    inning_action: DataFrame,
    team_streak: DataFrame,
    team_batting_counts: DataFrame,
    boxscore: DataFrame,
) -> DataFrame:
    """Everything known about a game in one row; a game lacking any input is dropped.

    The per-team inputs share the key (game, team) and are joined to each other first, so
    that the games are shuffled once per side instead of once per input.
    """
    team_lines = (
        box_totals(batter_counts)
        .join(starters(pitcher_counts, game_temp).drop("local_date"), ["game_id", "team_id"])
        .join(
            team_batting_counts.select("game_id", "team_id", "finalScore"),
            ["game_id", "team_id"],
        )
        .join(current_streaks(team_streak), ["game_id", "team_id"])
    )

    def side(prefix: str, team: str) -> DataFrame:
        return team_lines.select(
            "game_id",
            F.col("team_id").alias(team),
            *[F.col(c).alias(f"{prefix}_{c}") for c in [*_LINE, "sh", *_STARTER]],
            F.col("finalScore").alias(f"{prefix}_finalscore"),
            F.col("streak").alias(f"{prefix}_streak"),
        )

    temperature = replace_where_like(
        boxscore.select("game_id", "temp"), "temp", "%degrees", "degrees"
    )
    return (
        opponents(team_results)
        .join(side("home", "h_team"), ["game_id", "h_team"])
        .join(side("away", "a_team"), ["game_id", "a_team"])
        .join(substitutions(inning_action), "game_id")
        .join(temperature, "game_id")
    )


class _Totals:
    """Window totals of one side, reached as attributes."""

    def __init__(self, side: str):
        self._side = side

    def __getattr__(self, name: str) -> Column:
        return F.col(f"{self._side}_{name}")


def _batting_features(s: _Totals, babip_guard: Column) -> dict[str, Column]:
    total_bases = s.h + s.doubles + 2 * s.triples + 3 * s.hr
    extra_hits = s.doubles + s.triples + s.hr
    on_base = s.h + s.bb + s.hbp
    slugging = ratio(s.singles + 2 * s.doubles + 3 * s.triples + 4 * s.hr, s.ab)
    in_play = s.ab - s.k - s.hr + s.sf
    # Base runs: A runners, B advancement, C outs; the 1.02 belongs to the walks alone.
    runners = (s.h + s.bb - s.hr).cast("double")
    advance = (
        1.4 * total_bases.cast("double")
        - 0.6 * s.h.cast("double")
        - 3 * s.hr.cast("double")
        + 0.1 * s.bb.cast("double") * 1.02
    )
    chances = advance + (s.ab - s.h).cast("double")
    home_runs = s.hr.cast("double")
    return {
        "1b": s.singles,
        "2b": s.doubles,
        "3b": s.triples,
        "ab": s.ab,
        "at_bats_per_homerun": ratio(s.ab, s.hr),
        "batting_avg": ratio(s.h, s.ab, guard=s.h),
        "bb": s.bb,
        "babip": ratio(s.ab - s.hr, in_play, guard=babip_guard),
        "walk2strikeout_ratio": ratio(s.bb, s.k),
        "baserun": F.when(chances == 0.0, home_runs).otherwise(
            F.try_divide(runners * advance, chances) + home_runs
        ),
        "tb": total_bases,
        "groundfly_ratio": ratio(s.g, s.f),
        "xbh": extra_hits,
        "plate": s.plate,
        "strikeout": s.k,
        "strike_to_walk": ratio(s.k, s.bb),
        "slugging_avg": slugging,
        "tob": on_base,
        "sf": s.sf,
        "slugging_percentage": slugging,
        "on_base_percentage": ratio(on_base, s.ab + s.bb + s.hbp + s.sf),
        "plate_per_strike": ratio(s.plate, s.k),
        "iso": ratio(extra_hits, s.ab),
        "finalscore": s.finalscore,
        "p_strike_to_walk": ratio(s.p_k, s.p_bb),
        "p_ip": s.p_o.cast("double") / 3.0,
    }


def pair_features(games: DataFrame, days: int = 7, unit: str = "date",
                  clean: bool = False) -> DataFrame:
    """The full feature row of each game from earlier games of the same ordered pair.

    ``games`` is the result of ``game_rows``. As written, the rate on balls in play uses at
    bats for its numerator and guards the two sides differently, unreadable temperatures
    count as 0, and the current day's temperature is carried along. ``clean`` uses hits and
    the denominator as guard, leaves unreadable temperatures out of the mean and drops the
    current temperature, which a forecast could not know.
    """
    measures = {
        f"{side}_{name}": f"{side}_{name}"
        for side in ("home", "away")
        for name in [*_LINE, *_STARTER, "finalscore", "sub"]
    }
    degrees = whole_number("temp", invalid=None if clean else 0)
    measures["__degrees"] = degrees
    measures["__readings"] = degrees.isNotNull().cast("int")
    carried = ["game_id", "local_date", "h_team", "a_team", "current_home_streak",
               "current_away_streak", "current_temp", "hometeam_win"]
    rows = games.withColumnsRenamed(
        {"home_streak": "current_home_streak", "away_streak": "current_away_streak"}
    ).withColumn("current_temp", F.trim("temp"))
    home, away = _Totals("home"), _Totals("away")

    def in_play(s: _Totals) -> Column:
        return s.ab - s.k - s.hr + s.sf

    home_features = _batting_features(home, in_play(home) if clean else home.h)
    away_features = _batting_features(away, in_play(away))
    if clean:
        for features, s in ((home_features, home), (away_features, away)):
            features["babip"] = ratio(s.h - s.hr, in_play(s))
    cross = {
        "home_pitch_substute": home.sub,
        "away_pitch_substute": away.sub,
        "pitch_substract": home.sub - away.sub,
        "diff_xbh": home_features["xbh"] - away_features["xbh"],
    }
    of_pair = {f"h_{n}": c for n, c in home_features.items()}
    of_pair |= {f"a_{n}": c for n, c in away_features.items()}
    of_pair |= cross
    # Games of a pair on one day share these; they are worked out before the games join.
    told = with_trailing_totals(
        rows, ["h_team", "a_team"], "local_date", measures, days, unit=unit, carry=carried,
        derive=of_pair | {"avg_temp": F.try_divide(F.col("__degrees"), F.col("__readings"))},
    )
    current = [] if clean else [F.col("current_temp").alias("temp")]
    return told.select(
        "game_id",
        "local_date",
        "h_team",
        "a_team",
        *of_pair,
        F.col("current_home_streak").alias("home_streak"),
        F.col("current_away_streak").alias("away_streak"),
        "avg_temp",
        *current,
        "hometeam_win",
    )


def team_games(
    team_results: DataFrame,
    batter_counts: DataFrame,
    pitcher_counts: DataFrame,
    game_temp: DataFrame,
    team: int,
) -> DataFrame:
    """Games of one team, its own line first; the label is 1 only for wins at home."""
    lines = box_totals(batter_counts).join(
        starters(pitcher_counts, game_temp).drop("local_date"), ["game_id", "team_id"]
    )

    def side(prefix: str, key: str) -> DataFrame:
        return lines.select(
            "game_id",
            F.col("team_id").alias(key),
            *[F.col(c).alias(f"{prefix}_{c}")
              for c in ["h", "ab", "hr", "singles", "doubles", "triples", *_STARTER]],
        )

    mine = F.col("team_id") == team
    pairs = pair_rows(
        team_results, "game_id", "team_id", mine,
        {"local_date": "local_date", "own_team": "team_id", "own_side": "home_away",
         "own_result": "win_lose"},
        {"other_team": "team_id"},
    )
    label = F.when((F.col("own_side") == "H") & (F.col("own_result") == "W"), 1).otherwise(0)
    return (
        pairs.withColumn("hometeam_win", label)
        .join(side("home", "own_team"), ["game_id", "own_team"])
        .join(side("away", "other_team"), ["game_id", "other_team"])
    )


def team_features(games: DataFrame, days: int = 100) -> DataFrame:
    """Ten features of each game of ``team_games``, over all of the team's earlier games."""
    measures = {
        f"{side}_{name}": f"{side}_{name}"
        for side in ("home", "away")
        for name in ["h", "ab", "hr", "singles", "doubles", "triples", *_STARTER]
    }
    summed = with_trailing_totals(
        games, [], "local_date", measures, days,
        carry=["game_id", "local_date", "hometeam_win"],
    )

    def features(s: _Totals) -> dict[str, Column]:
        return {
            "batting_avg": ratio(s.h, s.ab),
            "home_run_per_hit": ratio(s.hr, s.h, guard=s.hr),
            "slugging_avg": ratio(s.singles + 2 * s.doubles + 3 * s.triples + 4 * s.hr, s.ab),
            "ip": s.p_o.cast("double") / 3.0,
            "strike_to_walk": ratio(s.p_k, s.p_bb),
        }

    return summed.select(
        "game_id",
        "local_date",
        *[c.alias(f"h_{n}") for n, c in features(_Totals("home")).items()],
        *[c.alias(f"a_{n}") for n, c in features(_Totals("away")).items()],
        "hometeam_win",
    )


def career_average(batter_counts: DataFrame) -> DataFrame:
    return grouped_ratio(batter_counts, ["batter"], "Hit", "atBat", "batting_average")


def batter_games(
    batters: DataFrame, dates: DataFrame, batter_counts: DataFrame
) -> DataFrame:
    """Hits and at bats of each batter in each dated game."""
    return (
        batters.select("game_id", "batter")
        .join(batter_counts.select("game_id", "batter", "Hit", "atBat"), ["game_id", "batter"])
        .join(dates.select("game_id", "local_date"), "game_id")
    )


def annual_average(lines: DataFrame) -> DataFrame:
    """Batting average per batter and year, from ``batter_games``."""
    return grouped_ratio(
        lines, ["batter", F.year("local_date").alias("year")], "Hit", "atBat",
        "batting_average",
    )


def rolling_average(lines: DataFrame, days: int = 100, unit: str = "date") -> DataFrame:
    """Trailing batting average per batter and game, from ``batter_games``.

    A batter entered more than once in a game gets one row, as a GROUP BY on
    (game, batter, date) would give.
    """
    keys = ["game_id", "batter", "local_date"]
    per_game = lines.groupBy(*keys).agg(F.sum("Hit").alias("Hit"), F.sum("atBat").alias("atBat"))
    return trailing_ratio(per_game, ["batter"], "local_date", "Hit", "atBat", days,
                          alias="rolling_batting", unit=unit, carry=keys).select(*keys, "rolling_batting")


def feature_table(
    read: Callable[[str], DataFrame], keep: Callable[[DataFrame, str], DataFrame],
    days: int = 7, clean: bool = False,
) -> DataFrame:
    """From raw tables to the feature row of every game.

    ``read`` gives a table by name, from a database or a folder. ``keep`` writes the assembled
    games and returns the stored table, which the window then reads twice.
    """
    names = ["team_results", "batter_counts", "pitcher_counts", "game_temp", "inning_action",
             "team_streak", "team_batting_counts", "boxscore"]
    rows = game_rows(**{n: read(n) for n in names})
    with settings(rows.sparkSession, CO_LOCATED):
        rows = keep(rows, "game_rows")
    return pair_features(rows, days, clean=clean)


def difference_features(df: DataFrame, first: str = "h_", second: str = "a_") -> DataFrame:
    """Add ``diff_x = first_x - second_x`` for every numeric pair of columns."""
    numeric = {n for n, t in df.dtypes if t in ("int", "bigint", "double", "float")}
    names = [
        c[len(first):] for c in df.columns
        if c.startswith(first) and c in numeric and second + c[len(first):] in numeric
    ]
    return df.withColumns(
        {f"diff_{n}": F.col(first + n) - F.col(second + n)
         for n in names if f"diff_{n}" not in df.columns}
    )


