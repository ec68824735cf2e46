"""Composite features: f01-f14, p10."""

from __future__ import annotations

from pyspark.sql import functions as F

from weekfold import config
from weekfold.operators import form, lifecycle, matchup, quality, team
from weekfold.queries import stages
from weekfold.queries.base_sql import add_table
from weekfold.queries.registry import query
from weekfold.sources import stand_ins as src

PLAYS_FROM = 1998  # the stand-in seasons 1998 on count as having plays


_NARROW = {"int", "smallint", "tinyint"}


def rounded(df, places: int = 6):
    """Doubles rounded, counts widened: the form results are compared in."""
    return widened(df.selectExpr(*[f"round(`{c}`, {places}) AS `{c}`" if t == "double" else f"`{c}`" for c, t in df.dtypes]))


def widened(df):
    return df.selectExpr(*[f"cast(`{c}` AS bigint) AS `{c}`" if t in _NARROW else f"`{c}`" for c, t in df.dtypes])


# --- f01, f02 -------------------------------------------------------------------
add_table("lifecycle", ("players", "rosters", "player_games"), """
SELECT p.player_id, p.gsis_id, p.espn_id, coalesce(r.f, s.f) AS first_season, coalesce(r.l, s.l) AS last_season,
  CASE WHEN r.t IS NOT NULL AND s.t IS NOT NULL THEN list_sort(list_distinct(list_concat(r.t, s.t))) ELSE coalesce(r.t, s.t) END AS career_teams,
  coalesce(p.position_group, p.position) AS primary_position, p.draft_year, p.draft_round, p.draft_pick, p.college,
  CASE WHEN p.status = 'RET' THEN 'retired'
       WHEN coalesce(r.l, s.l) < (SELECT max(season) FROM player_games) - 1 THEN 'inactive' ELSE 'active' END AS status
FROM players p
LEFT JOIN (SELECT gsis_id, min(season) AS f, max(season) AS l, list(DISTINCT team ORDER BY team) AS t FROM rosters GROUP BY gsis_id) r ON r.gsis_id = p.gsis_id
LEFT JOIN (SELECT player_id, min(season) AS f, max(season) AS l, list(DISTINCT team ORDER BY team) AS t FROM player_games GROUP BY player_id) s ON s.player_id = p.player_id""")


def lifecycles(spark, root):
    return lifecycle.lifecycle(src.players(spark, root), src.rosters(spark, root), src.player_games(spark, root))


@query("f01_lifecycle", """
SELECT player_id, gsis_id, espn_id, CAST(first_season AS BIGINT) AS first_season, CAST(last_season AS BIGINT) AS last_season,
  array_to_string(career_teams, ',') AS career_teams, primary_position, CAST(draft_year AS BIGINT) AS draft_year,
  CAST(draft_round AS BIGINT) AS draft_round, CAST(draft_pick AS BIGINT) AS draft_pick, college, status FROM lifecycle""", ["lifecycle"])
def f01(spark, root):
    out = lifecycles(spark, root).withColumn("career_teams", F.array_join("career_teams", ","))
    return rounded(out)


@query("f01_lifecycle_summary", """
SELECT count(*) AS total_players, count(*) FILTER (status = 'active') AS active, count(*) FILTER (status = 'retired') AS retired,
  count(*) FILTER (status = 'inactive') AS inactive, CAST(min(first_season) AS BIGINT) AS earliest_season, CAST(max(last_season) AS BIGINT) AS latest_season
FROM lifecycle""", ["lifecycle"])
def f01_summary(spark, root):
    return rounded(lifecycle.lifecycle_summary(lifecycles(spark, root)))


@query("f02_snapshot_members", """
SELECT team || '_' || season || '_W' || week AS snapshot_id, team, season, week, gsis_id, full_name AS name, position,
  depth_chart_position AS depth_position, jersey_number, status, years_exp, height, weight
FROM rosters WHERE status IN ('ACT', 'RES')""", ["rosters"])
def f02_members(spark, root):
    return lifecycle.snapshot_members(src.rosters(spark, root))


@query("f02_snapshot_depth", """
SELECT club_code || '_' || season || '_W' || week AS snapshot_id, club_code AS team, season, week, gsis_id, position,
  formation, depth_team, first_name || ' ' || last_name AS name FROM depth_charts""", ["depth_charts"])
def f02_depth(spark, root):
    return lifecycle.snapshot_depth(src.depth_charts(spark, root))


@query("f02_weekly_snapshot", """
SELECT m.team || '_' || m.season || '_W' || m.week AS snapshot_id, m.team, m.season, m.week,
  CAST(d.snapshot_date AS TIMESTAMP) AS snapshot_date, m.n AS members, coalesce(x.n, 0) AS depth_entries,
  (SELECT count(*) FROM rosters c WHERE c.team = m.team AND c.season = m.season AND c.week = m.week AND NOT EXISTS
    (SELECT 1 FROM rosters p WHERE p.team = c.team AND p.season = c.season AND p.week = c.week - 1 AND p.gsis_id = c.gsis_id)) AS new_players,
  (SELECT count(*) FROM rosters p WHERE p.team = m.team AND p.season = m.season AND p.week = m.week - 1 AND NOT EXISTS
    (SELECT 1 FROM rosters c WHERE c.team = p.team AND c.season = p.season AND c.week = p.week + 1 AND c.gsis_id = p.gsis_id)) AS removed_players
FROM (SELECT team, season, week, count(*) AS n FROM rosters WHERE status IN ('ACT', 'RES') GROUP BY 1, 2, 3) m
LEFT JOIN (SELECT team, season, week, min(gameday) AS snapshot_date FROM team_games GROUP BY 1, 2, 3) d USING (team, season, week)
LEFT JOIN (SELECT club_code AS team, season, week, count(*) AS n FROM depth_charts GROUP BY 1, 2, 3) x USING (team, season, week)""",
       ["rosters", "team_games", "depth_charts"])
def f02(spark, root):
    out = lifecycle.snapshot_index(src.rosters(spark, root), src.schedule(spark, root), src.depth_charts(spark, root))
    return out.withColumn("snapshot_date", F.col("snapshot_date").cast("timestamp"))


add_table("experience", ("lifecycle", "player_games"), """
SELECT DISTINCT g.player_id, g.season, g.season - l.first_season + 1 AS seasons_played,
  CASE WHEN g.season - l.first_season + 1 <= 1 THEN 'rookie' WHEN g.season - l.first_season + 1 IN (2, 3) THEN 'developing' ELSE 'veteran' END AS category
FROM player_games g JOIN lifecycle l ON l.player_id = g.player_id WHERE l.first_season IS NOT NULL""")


@query("f02_experience", """
SELECT player_id, CAST(season AS BIGINT) AS season, category, CAST(seasons_played AS BIGINT) AS seasons_played,
  CASE category WHEN 'rookie' THEN 'high_variance_model' WHEN 'developing' THEN 'mixed_model' ELSE 'historical_trend_model' END AS strategy,
  CAST(CASE category WHEN 'rookie' THEN 0.6 WHEN 'developing' THEN 0.8 ELSE 1.0 END AS DOUBLE) AS confidence
FROM experience""", ["experience"])
def f02_experience(spark, root):
    return rounded(lifecycle.experience(src.player_games(spark, root), lifecycles(spark, root)))


# --- f03, p10 ---------------------------------------------------------------------
_EXPR = {
    "avg": "avg({s}) {f}", "stddev": "stddev_samp({s}) {f}", "min": "min({s}) {f}", "max": "max({s}) {f}",
    "trend": "regr_slope({s}, CAST(game_number AS DOUBLE)) {f}",
}


def _masked(stats):
    out = []
    for s in stats:
        if s == "fantasy_points":
            out.append(s)
            continue
        inside = ", ".join(f"'{p}'" for p in form.relevant_positions(s))
        out.append(f"CASE WHEN position IN ({inside}) THEN CAST({s} AS DOUBLE) END AS {s}")
    return ", ".join(out)


def rolling_sql(stats, windows=(3, 5, 10), measures=("avg", "stddev", "trend", "min", "max"), drop_first=False):
    """Body computing the rolling measures of ``stats`` over player_games."""
    cols = []
    for n in windows:
        f = f"OVER (PARTITION BY player_id ORDER BY season, week ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
        for s in stats:
            for m in measures:
                e = _EXPR[m].format(s=s, f=f)
                cols.append(f"CASE WHEN isnan({e}) THEN NULL ELSE {e} END AS {s}_{m}_{n}")
        cols.append(f"count(*) {f} AS games_in_window_{n}")
    where = "WHERE game_number > 1" if drop_first else ""
    return f"""SELECT player_id, player_name, position, season, week, team, game_number, {', '.join(cols)}
FROM (SELECT player_id, player_name, position, season, week, team, {_masked(stats)},
        row_number() OVER (PARTITION BY player_id ORDER BY season, week) AS game_number
      FROM player_games WHERE season_type = 'REG') {where}"""


F03_STATS = ["passing_yards", "rushing_yards", "receiving_yards", "fg_pct", "target_share", "fantasy_points"]
TREND_STATS = [
    "passing_yards", "passing_tds", "rushing_yards", "attempts", "receiving_yards", "targets",
    "carries", "target_share", "fg_pct", "fg_att",
]


def _rounded_sql(table, stats, windows=(3, 5, 10), measures=("avg", "stddev", "trend", "min", "max")):
    cols = [
        f"round({s}_{m}_{n}, 6) AS {s}_{m}_{n}" for n in windows for s in stats for m in measures
    ] + [f"games_in_window_{n}" for n in windows]
    return f"SELECT player_id, player_name, position, CAST(season AS BIGINT) AS season, CAST(week AS BIGINT) AS week, CAST(team AS BIGINT) AS team, game_number, {', '.join(cols)} FROM {table}"


add_table("form_sample", ("player_games",), rolling_sql(F03_STATS))
add_table("form_dropped", ("player_games",), rolling_sql(["fantasy_points"], drop_first=True))
add_table("form_trends", ("player_games",), rolling_sql(TREND_STATS, (5,), ("trend",)))


@query("f03_rolling_features", _rounded_sql("form_sample", F03_STATS), ["form_sample"])
def f03(spark, root):
    return rounded(form.rolling_features(src.player_games(spark, root), F03_STATS))


@query("f03_drop_first_before", _rounded_sql("form_dropped", ["fantasy_points"]), ["form_dropped"])
def f03_dropped(spark, root):
    return rounded(form.rolling_features(src.player_games(spark, root), ["fantasy_points"], drop_first_before=True))


#: Every configured statistic that the stand-ins have.
_HAVE = {*src.COUNTS, *src.AMOUNTS, "fg_pct", "target_share", "air_yards_share", "fantasy_points_ppr"}
ALL_STATS = [*[s for s in config.all_stats() if s in _HAVE], "fantasy_points"]
_LONG = [f"{m}_{n}" for n in (3, 5, 10) for m in ("avg", "stddev", "trend", "min", "max")]


def _long_sql(table, stats):
    """The wide layout of ``table`` as a row for each statistic of the player's positions."""
    parts = []
    for s in stats:
        inside = ", ".join(f"'{p}'" for p in form.relevant_positions(s))
        where = "" if s == "fantasy_points" else (
            f" WHERE player_id IN (SELECT player_id FROM player_games WHERE season_type = 'REG' AND position IN ({inside}))"
        )
        parts.append(
            f"SELECT player_id, CAST(season AS BIGINT) AS season, CAST(week AS BIGINT) AS week, game_number, '{s}' AS stat, "
            + ", ".join(f"round({s}_{c}, 6) AS {c}" for c in _LONG)
            + f", games_in_window_3, games_in_window_5, games_in_window_10 FROM {table}{where}"
        )
    return "\nUNION ALL ".join(parts)


def _long(rows, stats):
    """Rounded where they are made: a decimal number for each value would take most of the time."""
    found = form.rolling_long_features(rows, stats, places=6)
    return widened(found.select(
        "player_id", "season", "week", "game_number", "stat", *_LONG, *[f"games_in_window_{n}" for n in (3, 5, 10)]
    ))


add_table("form_all", ("player_games",), rolling_sql(ALL_STATS))


@query("f03_rolling_long", _long_sql("form_all", ALL_STATS), ["form_all", "player_games"])
def f03_long(spark, root):
    """All statistics of the stand-ins, a row for each."""
    return _long(src.player_games(spark, root), ALL_STATS)


#: Configured statistics that the stand-ins lack, as counts made of what they have.
_MADE = {
    s: f"CAST((fantasy_points + {k} * week + season) % {17 + k} AS DOUBLE)"
    for k, s in enumerate(s for s in config.all_stats() if s not in ALL_STATS)
}
WIDENED = [*ALL_STATS, *_MADE]
add_table("widened_games", ("player_games",),
          "SELECT *, " + ", ".join(f"{e} AS {s}" for s, e in _MADE.items()) + " FROM player_games")
add_table("form_widened", ("widened_games",), rolling_sql(WIDENED).replace("FROM player_games", "FROM widened_games"))


@query("f03_rolling_full", _long_sql("form_widened", WIDENED), ["form_widened", "player_games"])
def f03_full(spark, root):
    """All configured statistics on a table that has them all."""
    rows = src.player_games(spark, root)
    return _long(rows.selectExpr("*", *[f"{e.replace('DOUBLE', 'double')} AS {s}" for s, e in _MADE.items()]), WIDENED)


_Z = "coalesce({s}_trend_5, 0)"
TREND_SQL = {
    "performance_trend": f"""CASE position
    WHEN 'QB' THEN 0.6 * {_Z.format(s='passing_yards')} + 0.3 * {_Z.format(s='passing_tds')} * 20 + 0.1 * {_Z.format(s='rushing_yards')}
    WHEN 'RB' THEN 0.6 * {_Z.format(s='rushing_yards')} + 0.3 * {_Z.format(s='receiving_yards')} + 0.1 * {_Z.format(s='carries')} * 4
    WHEN 'WR' THEN 0.7 * {_Z.format(s='receiving_yards')} + 0.3 * {_Z.format(s='targets')} * 10
    WHEN 'TE' THEN 0.7 * {_Z.format(s='receiving_yards')} + 0.3 * {_Z.format(s='targets')} * 10
    WHEN 'K' THEN fg_pct_trend_5 END""",
    "usage_trend": f"""CASE position WHEN 'QB' THEN attempts_trend_5
    WHEN 'RB' THEN {_Z.format(s='carries')} + {_Z.format(s='targets')}
    WHEN 'WR' THEN targets_trend_5 WHEN 'TE' THEN targets_trend_5 WHEN 'K' THEN fg_att_trend_5 END""",
    "target_share_trend": "CASE WHEN position IN ('RB', 'WR', 'TE') THEN target_share_trend_5 END",
}
add_table("trends", ("form_trends",), "SELECT player_id, position, season, week, "
          + ", ".join(f"round({e}, 9) AS {n}" for n, e in TREND_SQL.items()) + " FROM form_trends")


@query("p10_composite_trends", """
SELECT player_id, position, CAST(season AS BIGINT) AS season, CAST(week AS BIGINT) AS week,
  round(performance_trend, 6) AS performance_trend, round(usage_trend, 6) AS usage_trend,
  round(target_share_trend, 6) AS target_share_trend FROM trends""", ["trends"])
def p10(spark, root):
    rolled = form.rolling_features(src.player_games(spark, root), TREND_STATS, windows=(5,), measures=("trend",))
    return rounded(form.composite_trends(rolled).select("player_id", "position", "season", "week", *TREND_SQL))


_DOC_KEYS = ["passing_yards_avg", "rushing_yards_stddev", "receiving_yards_trend", "fg_pct_max", "fantasy_points_avg"]


@query("f03_sparse_documents", f"""
SELECT player_id, CAST(season AS BIGINT) AS season, CAST(week AS BIGINT) AS week, CAST(games_in_window_10 AS DOUBLE) AS games_in_window,
  {', '.join(f"round({k.rsplit('_', 1)[0]}_{k.rsplit('_', 1)[1]}_10, 6) AS {k}" for k in _DOC_KEYS)}
FROM form_sample""", ["form_sample"])
def f03_documents(spark, root):
    docs = form.documents(form.rolling_features(src.player_games(spark, root), F03_STATS))
    # one parse of the document serves every key
    parsed = F.from_json("stats_season_avg", "map<string,double>")
    return docs.select("player_id", "season", "week", parsed.alias("m")).select(
        "player_id", F.col("season").cast("bigint").alias("season"), F.col("week").cast("bigint").alias("week"),
        F.element_at("m", "games_in_window").alias("games_in_window"),
        *[F.round(F.element_at("m", k), 6).alias(k) for k in _DOC_KEYS],
    )


@query("q13_feature_json_check", """
SELECT position, count(*) AS total, 0::BIGINT AS missing_keys, count(*) FILTER (
  coalesce(passing_yards_avg_3, rushing_yards_avg_3, receiving_yards_avg_3, fg_pct_avg_3, target_share_avg_3, fantasy_points_avg_3) IS NULL) AS without_stats
FROM form_sample GROUP BY position""", ["form_sample"])
def q13(spark, root):
    docs = form.documents(form.rolling_features(src.player_games(spark, root), F03_STATS))
    return quality.check_feature_json(docs, "stats_last3_games")


# --- f04-f08 ------------------------------------------------------------------------
def games_of(spark, root):
    return src.player_games(spark, root), src.schedule(spark, root)


@query("f04_rest_and_division", """
SELECT g.player_id, CAST(g.season AS BIGINT) AS season, CAST(g.week AS BIGINT) AS week,
  CASE WHEN t.game_id IS NOT NULL THEN CAST(coalesce(t.rest, 7) AS BIGINT) END AS rest_days,
  CASE WHEN t.game_id IS NOT NULL THEN coalesce(CAST(t.div_game AS BOOLEAN), false) END AS divisional_game
FROM player_games g LEFT JOIN team_games t ON t.team = g.team AND t.season = g.season AND t.week = g.week""",
       ["player_games", "team_games"])
def f04(spark, root):
    out = matchup.with_game(*games_of(spark, root))
    return rounded(out.select("player_id", "season", "week", "rest_days", "divisional_game"))


_SPLIT_COLS = ", ".join(
    f"count(*) FILTER (t.game_role = '{r}') AS {r}_games, "
    f"round(coalesce(avg(b.fantasy_points) FILTER (t.game_role = '{r}'), 0.0), 6) AS {r}_avg_fantasy_points, "
    f"round(coalesce(avg(coalesce(b.passing_yards, 0) + coalesce(b.rushing_yards, 0) + coalesce(b.receiving_yards, 0)) "
    f"FILTER (t.game_role = '{r}'), 0.0), 6) AS {r}_avg_yards"
    for r in ("home", "away")
)


@query("f05_home_away_splits", f"""
SELECT a.player_id, CAST(a.season AS BIGINT) AS season, CAST(a.week AS BIGINT) AS week, {_SPLIT_COLS}
FROM player_games a
LEFT JOIN player_games b ON b.player_id = a.player_id AND (b.season < a.season OR (b.season = a.season AND b.week < a.week))
LEFT JOIN team_games t ON t.team = b.team AND t.season = b.season AND t.week = b.week
GROUP BY a.player_id, a.season, a.week""", ["player_games", "team_games"])
def f05(spark, root):
    out = matchup.with_splits(matchup.with_game(*games_of(spark, root)))
    return rounded(out.select("player_id", "season", "week", *[
        f"{r}_{m}" for r in ("home", "away") for m in ("games", "avg_fantasy_points", "avg_yards")
    ]))


@query("f06_opponent_history", """
SELECT player_id, CAST(season AS BIGINT) AS season, CAST(week AS BIGINT) AS week, back, CAST(m_season AS BIGINT) AS m_season, CAST(m_week AS BIGINT) AS m_week,
  round(points, 6) AS points, round(yards, 6) AS yards, CAST(tds AS BIGINT) AS tds FROM (
  SELECT a.player_id, a.season, a.week, b.season AS m_season, b.week AS m_week, coalesce(b.fantasy_points, 0.0) AS points,
    b.passing_yards + b.rushing_yards + b.receiving_yards AS yards, b.passing_tds + b.rushing_tds + b.receiving_tds AS tds,
    row_number() OVER (PARTITION BY a.player_id, a.season, a.week ORDER BY b.season DESC, b.week DESC) - 1 AS back
  FROM player_games a JOIN player_games b ON b.player_id = a.player_id AND b.opponent_team = a.opponent_team
    AND (b.season < a.season OR (b.season = a.season AND b.week < a.week))) WHERE back < 3""", ["player_games"])
def f06(spark, root):
    met = matchup.with_history(src.player_games(spark, root)).select(
        "player_id", "season", "week", F.posexplode("opp_history").alias("back", "h")
    )
    return rounded(met.select(
        "player_id", "season", "week", "back", F.col("h.season").alias("m_season"), F.col("h.week").alias("m_week"),
        F.col("h.fantasy_points").alias("points"), F.col("h.total_yards").alias("yards"),
        F.col("h.touchdowns").alias("tds"),
    ))


_METRIC_SQL = "CASE position WHEN 'QB' THEN passing_yards WHEN 'RB' THEN rushing_yards WHEN 'WR' THEN receiving_yards WHEN 'TE' THEN receiving_yards WHEN 'K' THEN fg_made WHEN 'DEF' THEN def_tackles_solo END"
add_table("defence_ranks", ("player_games", "team_stats"), f"""
SELECT *, rank() OVER (PARTITION BY season, week, position ORDER BY round(avg_allowed, 9)) AS defense_rank FROM (
  SELECT t.team, t.season, t.week, p.position, coalesce(avg(CAST(g.v AS DOUBLE)), 0.0) AS avg_allowed
  FROM (SELECT DISTINCT team, season, week FROM team_stats) t
  CROSS JOIN (SELECT unnest(['QB', 'RB', 'WR', 'TE', 'K', 'DEF']) AS position) p
  LEFT JOIN (SELECT opponent_team, season, week, position, {_METRIC_SQL} AS v FROM player_games) g
    ON g.opponent_team = t.team AND g.season = t.season AND g.week = t.week AND g.position = p.position
  GROUP BY t.team, t.season, t.week, p.position)""")


@query("f07_defence_rank", """
SELECT CAST(team AS BIGINT) AS team, CAST(season AS BIGINT) AS season, CAST(week AS BIGINT) AS week, position, round(avg_allowed, 6) AS avg_allowed, defense_rank
FROM defence_ranks""", ["defence_ranks"])
def f07(spark, root):
    return rounded(matchup.defence_ranks(src.player_games(spark, root), src.team_stats(spark, root)))


def _allowed_sql():
    """Long form: one row per (player row, statistic) of the position's first ten."""
    from weekfold.sources.stand_ins import STATS

    parts = []
    for p in config.POSITION_STATS:
        names = [s for s in config.position_stats(p)[: config.ALLOWED_STATS] if s in STATS]
        parts += [
            f"SELECT player_id, season, week, '{s}' AS stat, coalesce(avg_{s}, 0.0) AS value FROM allowed WHERE position = '{p}'"
            for s in names
        ]
    union = list(dict.fromkeys(
        s for p in config.POSITION_STATS for s in config.position_stats(p)[: config.ALLOWED_STATS] if s in STATS
    ))
    means = ", ".join(f"avg(coalesce(CAST(b.{s} AS DOUBLE), 0.0)) AS avg_{s}" for s in union)
    base = f"""
SELECT a.player_id, a.season, a.week, a.position, {means} FROM player_games a
LEFT JOIN player_games b ON b.opponent_team = a.opponent_team AND b.position = a.position
  AND (b.season < a.season OR (b.season = a.season AND b.week < a.week)) AND b.season >= a.season - 1
GROUP BY a.player_id, a.season, a.week, a.position"""
    return base, "\nUNION ALL ".join(parts)


_ALLOWED_BASE, _ALLOWED_LONG = _allowed_sql()
# averaging a missing row as 0 matches the default of 0.0 for no earlier games
add_table("allowed", ("player_games",), _ALLOWED_BASE)


@query("f08_opponent_allowed", f"""
SELECT player_id, CAST(season AS BIGINT) AS season, CAST(week AS BIGINT) AS week, stat, round(value, 8) AS value
FROM ({_ALLOWED_LONG})""", ["allowed"])
def f08(spark, root):
    stats = src.player_games(spark, root)
    on = ["opponent_team", "position", "season", "week"]
    allowed = stats.select("player_id", *on).join(matchup.defence_allowed(stats), on, "left")
    return rounded(allowed.select("player_id", "season", "week", F.explode("opp_allowed").alias("stat", "value")), 8)


@query("f08_matchup_features", """
SELECT g.player_id, CAST(g.season AS BIGINT) AS season, CAST(g.week AS BIGINT) AS week,
  CASE WHEN t.game_id IS NOT NULL THEN CAST(coalesce(t.rest, 7) AS BIGINT) END AS rest_days,
  CAST(coalesce(r.defense_rank, 16) AS BIGINT) AS opp_rank_vs_position,
  (SELECT CAST(least(count(*), 3) AS BIGINT) FROM player_games b WHERE b.player_id = g.player_id AND b.opponent_team = g.opponent_team
     AND (b.season < g.season OR (b.season = g.season AND b.week < g.week))) AS meetings
FROM player_games g
LEFT JOIN team_games t ON t.team = g.team AND t.season = g.season AND t.week = g.week
LEFT JOIN defence_ranks r ON r.team = g.opponent_team AND r.season = g.season AND r.week = g.week AND r.position = g.position
WHERE g.season_type = 'REG'""", ["player_games", "team_games", "defence_ranks"])
def f08_matchup(spark, root):
    stats, games = stages.games(spark, root), stages.schedule(spark, root)
    features = form.rolling_features(stats, ["fantasy_points"], windows=(3,), measures=("avg",))
    out = matchup.matchup(features.select("player_id", "season", "week"), stats, games, stages.team_stats(spark, root))
    return rounded(out.select(
        "player_id", "season", "week", "rest_days", "opp_rank_vs_position",
        F.coalesce(F.size("opp_history"), F.lit(0)).alias("meetings"),
    ))


# --- f09-f14 ------------------------------------------------------------------------
def _window_sql(team_col, select, where="true", having=""):
    """Metric over plays of weeks [N-3, N-1] for every target week N."""
    return f"""
SELECT CAST({team_col} AS BIGINT) AS team, CAST(season AS BIGINT) AS season, CAST(week + k AS BIGINT) AS week, {select}
FROM plays, (SELECT unnest([1, 2, 3]) AS k) WHERE {where} GROUP BY {team_col}, season, week + k {having}"""


_SCRIM = "play_type IN ('pass', 'run') AND play = 1"
_OFF_SELECT = f"""
  coalesce(avg(epa) FILTER ({_SCRIM} AND epa IS NOT NULL), 0.0) AS off_epa_per_play_last3,
  coalesce(count(*) FILTER ({_SCRIM} AND epa IS NOT NULL AND success = 1) / nullif(CAST(count(*) FILTER ({_SCRIM} AND epa IS NOT NULL) AS DOUBLE), 0), 0.5) AS off_success_rate_last3,
  coalesce(count(*) FILTER ({_SCRIM} AND epa IS NOT NULL AND yards_gained > 10) / nullif(CAST(count(*) FILTER ({_SCRIM} AND epa IS NOT NULL) AS DOUBLE), 0), 0.0) AS off_explosive_play_rate,
  coalesce(sum(third_down_converted) FILTER (down = 3) / nullif(CAST(sum(third_down_converted) FILTER (down = 3) + sum(third_down_failed) FILTER (down = 3) AS DOUBLE), 0), 0.0) AS off_third_down_conv"""
_DEF_SELECT = f"""
  coalesce(avg(epa) FILTER ({_SCRIM}), 0.0) AS def_epa_per_play_last3,
  coalesce(count(*) FILTER ({_SCRIM} AND success = 0) / nullif(CAST(count(*) FILTER ({_SCRIM}) AS DOUBLE), 0), 0.5) AS def_success_rate_last3,
  coalesce((sum(qb_hit) + sum(sack)) / nullif(CAST(sum(pass_attempt) AS DOUBLE), 0), 0.0) AS def_pressure_rate,
  coalesce((sum(interception) + sum(fumble_lost)) / nullif(CAST(count(DISTINCT game_id || ':' || drive) AS DOUBLE), 0), 0.0) AS def_turnover_rate"""
_NEUTRAL_COND = "score_differential BETWEEN -7 AND 7 AND quarter_seconds_remaining > 120 AND down IN (1, 2) AND play = 1"
_NEUTRAL_SELECT = f"""
  coalesce(sum(pass_attempt) FILTER ({_NEUTRAL_COND}) / nullif(CAST(sum(pass_attempt) FILTER ({_NEUTRAL_COND}) + sum(rush_attempt) FILTER ({_NEUTRAL_COND}) AS DOUBLE), 0), 0.5) AS pass_rate_neutral"""


def _drive_sql(key, select, inner, where="true"):
    keys = ", ".join(key)
    return f"""
SELECT CAST(posteam AS BIGINT) AS team, CAST(season AS BIGINT) AS season, CAST(n AS BIGINT) AS week, {select}
FROM (SELECT posteam, season, week + k AS n, {keys}, {inner} FROM plays, (SELECT unnest([1, 2, 3]) AS k)
      WHERE {where} GROUP BY ALL) GROUP BY posteam, season, n"""


_RZ = "coalesce(sum(scored) / nullif(CAST(count(scored) AS DOUBLE), 0), 0.5) AS off_red_zone_efficiency"
_RZ_INNER = "max(touchdown) FILTER (yardline_100 <= 20) AS scored"
_PACE_SELECT = """coalesce(avg(drive_play_count), 65.0) AS pace_of_play,
  coalesce(sum(CAST(split_part(drive_time_of_possession, ':', 1) AS INTEGER) * 60 + CAST(split_part(drive_time_of_possession, ':', 2) AS INTEGER))
    / nullif(CAST(60 * count(*) AS DOUBLE), 0), 30.0) AS time_of_possession_avg"""


# team metrics are ratios of exact sums, so they are compared unrounded
def _exact(df):
    return df.selectExpr(*[
        f"cast(`{c}` AS bigint) AS `{c}`" if t == "int" else f"`{c}`" for c, t in df.dtypes
    ])


def _picked(sql, names):
    return f"SELECT team, season, week, {', '.join(names)} FROM ({sql})"


add_table("team_offence", ("plays",), _window_sql("posteam", _OFF_SELECT))
add_table("team_defence", ("plays",), _window_sql("defteam", _DEF_SELECT))
add_table("team_neutral", ("plays",), _window_sql("posteam", _NEUTRAL_SELECT))
add_table("team_red_zone", ("plays",), _drive_sql(("game_id", "drive"), _RZ, _RZ_INNER))
add_table("team_pace", ("plays",), _drive_sql(("game_id", "drive", "drive_play_count", "drive_time_of_possession"), _PACE_SELECT, "count(*) AS plays"))


@query("f09_offence_last3", _picked("SELECT * FROM team_offence", team.OFFENCE), ["team_offence"])
def f09(spark, root):
    return _exact(team.offence(src.plays(spark, root)))


@query("f10_red_zone", _picked("SELECT * FROM team_red_zone", team.RED_ZONE), ["team_red_zone"])
def f10(spark, root):
    return _exact(team.red_zone(src.plays(spark, root)))


@query("f10_red_zone_shared_drive_ids", _picked(_drive_sql(("drive % 50 AS d",), _RZ, _RZ_INNER), team.RED_ZONE), ["plays"])
def f10_shared(spark, root):
    # drive numbers that repeat between games, keyed by the number alone
    shared = src.plays(spark, root).withColumn("drive", F.col("drive") % 50)
    return _exact(team.red_zone(shared, drive_key=("drive",)))


@query("f11_defence_last3", _picked("SELECT * FROM team_defence", team.DEFENCE), ["team_defence"])
def f11(spark, root):
    return _exact(team.defence(src.plays(spark, root)))


@query("f12_neutral_pass_rate", _picked("SELECT * FROM team_neutral", team.NEUTRAL), ["team_neutral"])
def f12(spark, root):
    return _exact(team.neutral_pass_rate(src.plays(spark, root)))


@query("f13_pace", _picked("SELECT * FROM team_pace", team.PACE), ["team_pace"])
def f13(spark, root):
    return _exact(team.pace(src.plays(spark, root)))


_TEAM_COLS = ", ".join(
    f"coalesce({m}, {v}) AS {m}" for m, v in config.TEAM_METRICS.items()
)
add_table(
    "team_features",
    ("plays", "team_stats", "team_offence", "team_defence", "team_neutral", "team_red_zone", "team_pace"),
    f"""
SELECT team, season, week, {_TEAM_COLS} FROM (
  SELECT DISTINCT CAST(posteam AS BIGINT) AS team, CAST(season AS BIGINT) AS season, CAST(week AS BIGINT) AS week
  FROM plays WHERE season >= {PLAYS_FROM} AND season_type = 'REG' AND week > 3) t
LEFT JOIN team_offence USING (team, season, week) LEFT JOIN team_defence USING (team, season, week)
LEFT JOIN team_neutral USING (team, season, week) LEFT JOIN team_red_zone USING (team, season, week)
LEFT JOIN team_pace USING (team, season, week)
UNION ALL
SELECT CAST(team AS BIGINT), CAST(season AS BIGINT), CAST(week AS BIGINT), {', '.join(f'CAST({v} AS DOUBLE)' for v in config.TEAM_METRICS.values())}
FROM team_stats WHERE week > 3 AND season NOT IN (SELECT DISTINCT season FROM plays WHERE season >= {PLAYS_FROM})""")


def team_features(spark, root):
    return team.team_aggregates(src.plays(spark, root), src.team_stats(spark, root), PLAYS_FROM)


@query("f14_team_aggregates", _picked("SELECT * FROM team_features", config.TEAM_METRICS), ["team_features"])
def f14(spark, root):
    return _exact(team_features(spark, root))


@query("q09_team_validation", """
SELECT count(*) AS total_records,
  count(*) FILTER (off_epa_per_play_last3 NOT BETWEEN -3 AND 3 OR def_epa_per_play_last3 NOT BETWEEN -3 AND 3) AS invalid_epa,
  count(*) FILTER (off_success_rate_last3 NOT BETWEEN 0 AND 1 OR def_success_rate_last3 NOT BETWEEN 0 AND 1) AS invalid_success,
  count(*) FILTER (off_epa_per_play_last3 IS NULL OR def_epa_per_play_last3 IS NULL) AS null_epa,
  count(DISTINCT team) AS unique_teams, count(DISTINCT season) AS seasons, min(season) AS earliest_season, max(season) AS latest_season,
  round(avg(off_epa_per_play_last3), 6) AS avg_off_epa, round(avg(def_epa_per_play_last3), 6) AS avg_def_epa
FROM team_features""", ["team_features"])
def q09(spark, root):
    return rounded(quality.validate_team(team_features(spark, root)))
