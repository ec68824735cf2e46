"""Feature vectors, quality, targets and splits: f15, x04, q01-q06, g01-g02, v01-v06, l01-l05."""

from __future__ import annotations

from pyspark.sql import functions as F

from weekfold import config
from weekfold.operators import quality, targets, temporal
from weekfold.operators import training as tr
from weekfold.plans import dataset
from weekfold.queries import stages
from weekfold.queries.base_sql import add_table
from weekfold.queries.features import TREND_STATS, rolling_sql, rounded
from weekfold.queries.registry import query
from weekfold.queries.stages import scored, with_outcomes

# --- the DuckDB counterpart of the assembled vectors -----------------------------------
_VECTOR_STATS = dataset.vector_stats()
add_table("form_vector", ("player_games",), rolling_sql(_VECTOR_STATS, measures=("avg",)))


def _vector_sql():
    shared = {
        "performance_trend": "t.performance_trend", "usage_trend": "t.usage_trend",
        "target_share_trend": "t.target_share_trend",
        "opp_rank_vs_position": "coalesce(r.defense_rank, 16)",
        "rest_days": "CASE WHEN x.game_id IS NOT NULL THEN coalesce(x.rest, 7) END",
    }
    parts = []
    for n in config.VECTOR_UNIVERSAL:
        if n in shared:
            e = shared[n]
        elif n.startswith("opp_def"):
            e = f"o.{n[4:]}"
        else:
            e = f"m.{n}"
        parts.append(f"coalesce(CAST({e} AS DOUBLE), 0.0)")
    pieces = ["[" + ", ".join(parts) + "]"]
    for w in config.VECTOR_WINDOWS.values():
        cases = " ".join(
            f"WHEN '{p}' THEN [" + ", ".join(
                f"coalesce(f.{s}_avg_{w}, 0.0)" if s else "CAST(0.0 AS DOUBLE)" for s, _ in slots
            ) + "]"
            for p, slots in config.VECTOR_STATS.items()
        )
        pieces.append(f"CASE f.position {cases} END")
    return " || ".join(pieces)


def _names_sql():
    return "CASE f.position " + " ".join(
        f"WHEN '{p}' THEN [" + ", ".join(f"'{n}'" for n in config.vector_names(p)) + "]"
        for p in config.VECTOR_STATS
    ) + " END"


add_table(
    "features",
    ("player_games", "form_vector", "trends", "team_games", "defence_ranks", "team_features", "experience"),
    f"""
SELECT c.player_id || '_' || c.season || '_' || c.week AS feature_id, c.player_id AS entity_id, c.season, c.week,
  gc.gameday AS game_date, f.position, c.team, c.opponent_team, e.category AS experience,
  coalesce(gc.game_role, 'neutral') AS home_away,
  CASE WHEN x.game_id IS NOT NULL THEN coalesce(CAST(x.div_game AS BOOLEAN), false) ELSE false END AS divisional_game,
  {_vector_sql()} AS numerical, {_names_sql()} AS names
FROM (SELECT DISTINCT player_id, season, week, team, opponent_team FROM player_games WHERE week > 1) c
JOIN form_vector f ON f.player_id = c.player_id AND f.season = c.season AND f.week + 1 = c.week
JOIN trends t ON t.player_id = f.player_id AND t.season = f.season AND t.week = f.week
JOIN player_games last ON last.player_id = f.player_id AND last.season = f.season AND last.week = f.week
LEFT JOIN team_games x ON x.team = last.team AND x.season = last.season AND x.week = last.week
LEFT JOIN defence_ranks r ON r.team = last.opponent_team AND r.season = last.season AND r.week = last.week AND r.position = last.position
LEFT JOIN team_games gc ON gc.team = c.team AND gc.season = c.season AND gc.week = c.week AND gc.game_type = 'REG'
LEFT JOIN team_features m ON m.team = c.team AND m.season = c.season AND m.week + 1 = c.week
LEFT JOIN team_features o ON o.team = c.opponent_team AND o.season = c.season AND o.week + 1 = c.week
LEFT JOIN experience e ON e.player_id = c.player_id AND e.season = c.season
WHERE f.position IN ('QB', 'RB', 'WR', 'TE', 'K') AND f.week < 18""",
)


@query("x04_vector_values", """
SELECT feature_id, slot, names[slot + 1] AS name, round(numerical[slot + 1], 6) AS value
FROM features, (SELECT unnest(range(47)) AS slot)""", ["features"])
def x04(spark, root):
    f = stages.features(spark, root).select("feature_id", F.posexplode(F.arrays_zip("names", "numerical")).alias("slot", "z"))
    return rounded(f.select("feature_id", "slot", F.col("z.names").alias("name"), F.col("z.numerical").alias("value")))


@query("f15_vector_assembly", """
SELECT feature_id, entity_id, CAST(season AS BIGINT) AS season, CAST(week AS BIGINT) AS week, CAST(game_date AS TIMESTAMP) AS game_date,
  position, CAST(team AS BIGINT) AS team, CAST(opponent_team AS BIGINT) AS opponent_team, experience, home_away,
  CAST(CASE home_away WHEN 'home' THEN 1 WHEN 'away' THEN 0 ELSE -1 END AS BIGINT) AS home_away_code, divisional_game,
  CAST(len(numerical) AS BIGINT) AS width, round(list_sum(numerical), 4) AS checksum
FROM features""", ["features"])
def f15(spark, root):
    f = stages.features(spark, root)
    return rounded(f.select(
        "feature_id", "entity_id", "season", "week", F.col("game_date").cast("timestamp").alias("game_date"),
        "position", "team", "opponent_team", "experience",
        F.col("categorical.home_away.value").alias("home_away"),
        F.col("categorical.home_away.encoded").alias("home_away_code"),
        F.col("categorical.divisional_game.value").alias("divisional_game"),
        F.size("numerical").alias("width"),
        F.round(F.aggregate("numerical", F.lit(0.0), lambda a, b: a + b), 4).alias("checksum"),
    ))


@query("f15_dataset_summary", """
SELECT position, count(*) AS n, round(avg(len(numerical)), 6) AS avg_features FROM features GROUP BY position""", ["features"])
def f15_summary(spark, root):
    return rounded(dataset.dataset_summary(stages.features(spark, root)))


# --- quality --------------------------------------------------------------------------
_RATIO = "len(list_filter(numerical, lambda x: x <> 0.0)) / CAST(len(numerical) AS DOUBLE)"
_EXTREME = "len(list_filter(numerical, lambda x: abs(x) > 1000.0))"
add_table("scored", ("features",), f"""
SELECT *, (completeness_score * 0.6 + outlier_score * 0.2 + recency_score * 0.2) * critical AS quality,
  list_filter([CASE WHEN completeness_ratio < 0.5 THEN 'low_completeness' END, CASE WHEN extreme_values > 5 THEN 'high_outliers' END,
    CASE WHEN position IS NULL THEN 'missing_position' END, CASE WHEN team IS NULL THEN 'missing_team' END,
    CASE WHEN opponent_team IS NULL THEN 'missing_opponent' END, CASE WHEN weeks_ago > 35 THEN 'stale_data' END], lambda x: x IS NOT NULL) AS flags
FROM (SELECT *,
  CAST(CASE WHEN completeness_ratio >= 0.9 THEN 1.0 WHEN completeness_ratio >= 0.75 THEN 0.8 WHEN completeness_ratio >= 0.5 THEN 0.6 WHEN completeness_ratio >= 0.25 THEN 0.3 ELSE 0.0 END AS DOUBLE) AS completeness_score,
  CAST(CASE WHEN extreme_values = 0 THEN 1.0 WHEN extreme_values <= 2 THEN 0.9 WHEN extreme_values <= 5 THEN 0.7 WHEN extreme_values <= 10 THEN 0.5 ELSE 0.0 END AS DOUBLE) AS outlier_score,
  CAST(CASE WHEN weeks_ago <= 4 THEN 1.0 WHEN weeks_ago <= 8 THEN 0.9 WHEN weeks_ago <= 17 THEN 0.8 WHEN weeks_ago <= 35 THEN 0.7 ELSE 0.5 END AS DOUBLE) AS recency_score,
  CAST(CASE WHEN position IS NOT NULL AND team IS NOT NULL AND opponent_team IS NOT NULL THEN 1.0 ELSE 0.0 END AS DOUBLE) AS critical
FROM (SELECT *, {_RATIO} AS completeness_ratio, {_EXTREME} AS extreme_values,
  ((SELECT max(season) FROM features) - season) * 18 + ((SELECT max(week) FROM features) - week) AS weeks_ago FROM features))""")


def _score_query(name, columns, sql_columns):
    @query(name, f"SELECT feature_id, {sql_columns} FROM scored", ["scored"])
    def run(spark, root):
        return rounded(scored(spark, root).select("feature_id", *columns))


_score_query("q01_completeness_score", ["completeness_ratio", "completeness_score"],
             "round(completeness_ratio, 6) AS completeness_ratio, completeness_score")
_score_query("q02_outlier_score", ["extreme_values", "outlier_score"],
             "CAST(extreme_values AS BIGINT) AS extreme_values, outlier_score")
_score_query("q03_recency_score", ["weeks_ago", "recency_score"],
             "CAST(weeks_ago AS BIGINT) AS weeks_ago, recency_score")
_score_query("q04_critical_gate", ["critical"], "critical")


@query("q05_quality_filter", """
SELECT feature_id, round(quality, 6) AS quality FROM scored WHERE NOT coalesce(quality < 0.5, false)""", ["scored"])
def q05(spark, root):
    return rounded(quality.passing(scored(spark, root)).select("feature_id", "quality"))


@query("q05_quality_summary", """
SELECT count(*) AS scored, count(*) FILTER (quality >= 0.5) AS passed, count(*) FILTER (quality < 0.5) AS filtered,
  round(avg(quality), 6) AS avg_score, round(min(quality), 6) AS min_score, round(max(quality), 6) AS max_score FROM scored""", ["scored"])
def q05_summary(spark, root):
    return rounded(quality.quality_summary(scored(spark, root)))


@query("q06_data_flags", """
SELECT feature_id, array_to_string(flags, ',') AS flags FROM scored""", ["scored"])
def q06(spark, root):
    return scored(spark, root).select("feature_id", F.array_join("flags", ",").alias("flags"))


# --- targets --------------------------------------------------------------------------
def _outcome_sql():
    rows = []
    rate = "coalesce(g.{a} / nullif(CAST(g.{b} AS DOUBLE), 0), 0.0)"
    for p, spec in config.OUTCOMES.items():
        entries = {s: f"coalesce(CAST(g.{s} AS DOUBLE), 0.0)" for s in spec["stats"]}
        entries |= {n: rate.format(a=a, b=b) for n, a, b in spec["rates"]}
        if p == "K":
            entries["fantasy_points_standard"] = "coalesce(CAST(g.fg_made * 3.0 + g.pat_made AS DOUBLE), 0.0)"
        entries["team_points"] = "CAST(t.points AS DOUBLE)"
        entries["team_won"] = "CASE WHEN t.game_id IS NULL THEN NULL WHEN t.points > t.points_against THEN 1.0 WHEN t.points < t.points_against THEN 0.0 ELSE 0.5 END"
        rows += [
            f"SELECT f.feature_id, f.position, f.season, f.week, '{n}' AS target, CAST({e} AS DOUBLE) AS value FROM features f "
            f"LEFT JOIN player_games g ON g.player_id = f.entity_id AND g.season = f.season AND g.week = f.week "
            f"LEFT JOIN team_games t ON t.team = g.team AND t.season = g.season AND t.week = g.week AND t.game_type = 'REG' "
            f"WHERE f.position = '{p}'"
            for n, e in entries.items()
        ]
    return "\nUNION ALL ".join(rows)


add_table("outcome_rows", ("features", "player_games", "team_games"), _outcome_sql())


@query("g01_prediction_targets", """
SELECT feature_id, target, round(value, 6) AS value,
  CASE position WHEN 'QB' THEN 'passing_yards' WHEN 'RB' THEN 'rushing_yards' WHEN 'WR' THEN 'receiving_yards' WHEN 'TE' THEN 'receiving_yards' WHEN 'K' THEN 'fg_made' ELSE 'fantasy_points_ppr' END AS prediction_target
FROM outcome_rows""", ["outcome_rows"])
def g01(spark, root):
    found = targets.targets(stages.features(spark, root), stages.games(spark, root), stages.schedule(spark, root))
    return rounded(found.select("feature_id", F.explode("outcomes").alias("target", "value"), "prediction_target"))


@query("g01_target_summary", """
SELECT f.position, count(*) AS total, count(*) AS with_targets, round(avg(coalesce(a.value, b.value, 0.0)), 6) AS avg_fantasy_points
FROM features f LEFT JOIN outcome_rows a ON a.feature_id = f.feature_id AND a.target = 'fantasy_points_ppr'
LEFT JOIN outcome_rows b ON b.feature_id = f.feature_id AND b.target = 'fantasy_points_standard'
GROUP BY f.position""", ["outcome_rows"])
def g01_summary(spark, root):
    return rounded(targets.target_summary(with_outcomes(spark, root)))


@query("g02_no_target_flag", """
SELECT feature_id, array_to_string(CASE WHEN season >= 2000 THEN list_append(flags, 'no_target_data') ELSE flags END, ',') AS flags
FROM scored""", ["scored"])
def g02(spark, root):
    # outcomes are known for the seasons before 2000 only
    rows = with_outcomes(spark, root, F.col("season") < 2000)
    return rows.select("feature_id", F.array_join("flags", ",").alias("flags"))


# --- splits and leak checks -----------------------------------------------------------
add_table("split_features", ("features",), """
SELECT f.*, CASE WHEN r > n * 0.9 THEN 'test' WHEN r > n * 0.7 THEN 'validation' ELSE 'train' END AS split
FROM features f JOIN (SELECT season, week, row_number() OVER (ORDER BY season, week) AS r, count(*) OVER () AS n
  FROM (SELECT DISTINCT season, week FROM features)) USING (season, week)""")


@query("v01_first_period_check", "SELECT count(*) FILTER (week = 1) AS violations FROM features", ["features"])
def v01(spark, root):
    log = temporal.leak_checks(stages.training(spark, root))
    return log.filter(F.col("check_name") == "week_1_features").select("violations")


@query("v02_feature_name_check", """
SELECT count(DISTINCT n) AS violations FROM (SELECT unnest(names) AS n FROM features)
WHERE n LIKE '%win%' OR n LIKE '%loss%' OR n LIKE '%final%' OR n LIKE '%result%' OR n LIKE '%outcome%'""", ["features"])
def v02(spark, root):
    return temporal.leaking_names(stages.features(spark, root)).agg(F.count(F.lit(1)).alias("violations"))


@query("v03_temporal_split", "SELECT feature_id, split FROM split_features", ["split_features"])
def v03(spark, root):
    return temporal.temporal_split(stages.features(spark, root)).select("feature_id", "split")


@query("v04_split_order", """
SELECT split, CAST(min(season * 100 + week) AS BIGINT) AS earliest, CAST(max(season * 100 + week) AS BIGINT) AS latest
FROM split_features GROUP BY split""", ["split_features"])
def v04(spark, root):
    return rounded(temporal.split_ranges(temporal.temporal_split(stages.features(spark, root))))


@query("v05_target_completeness", """
SELECT split, count(*) AS total_rows, count(*) FILTER (season < 2000) AS rows_with_targets,
  round(100.0 * count(*) FILTER (season < 2000) / count(*), 6) AS target_pct FROM split_features GROUP BY split""", ["split_features"])
def v05(spark, root):
    rows = with_outcomes(spark, root, F.col("season") < 2000)
    return rounded(temporal.target_completeness(temporal.temporal_split(rows)))


@query("v06_validation_log", """
SELECT 'week_1_features' AS check_name, count(*) FILTER (week = 1) = 0 AS passed, count(*) FILTER (week = 1) AS violations FROM features
UNION ALL SELECT 'future_outcome_leakage', true, 0
UNION ALL SELECT 'split_temporal_order', true, 0
UNION ALL SELECT 'data_completeness', true, 0""", ["features"])
def v06(spark, root):
    return temporal.leak_checks(stages.training(spark, root)).select("check_name", "passed", "violations")


# --- training frame -------------------------------------------------------------------
@query("l01_training_read", """
SELECT feature_id, position, CAST(season AS BIGINT) AS season, CAST(week AS BIGINT) AS week, round(quality, 6) AS quality
FROM scored WHERE season BETWEEN 1996 AND 2000 AND coalesce(quality, 1.0) >= 0.6 AND position = 'RB'""", ["scored"])
def l01(spark, root):
    rows = tr.training_set(with_outcomes(spark, root), 1996, 2000, 0.6, "RB")
    return rounded(rows.select("feature_id", "position", "season", "week", "quality"))


@query("l02_ratio_split", """
SELECT feature_id, CASE WHEN r <= floor(n * 0.7) THEN 'train' WHEN r <= floor(n * 0.7) + floor(n * 0.2) THEN 'validation' ELSE 'test' END AS split
FROM (SELECT feature_id, row_number() OVER (ORDER BY season, week, md5(feature_id)) AS r, count(*) OVER () AS n FROM features)""", ["features"])
def l02(spark, root):
    return temporal.ratio_split(stages.features(spark, root)).select("feature_id", "split")


@query("l03_feature_matrix", """
SELECT feature_id, CAST(len(numerical) AS BIGINT) AS width, round(list_sum(numerical), 4) AS checksum FROM features""", ["features"])
def l03(spark, root):
    from pyspark.ml.functions import vector_to_array

    ml = tr.to_ml_frame(with_outcomes(spark, root), "fantasy_points_ppr").select(
        "feature_id", vector_to_array("features").alias("a")
    )
    return ml.select(
        "feature_id", F.size("a").cast("bigint").alias("width"),
        F.round(F.aggregate("a", F.lit(0.0), lambda x, y: x + y), 4).alias("checksum"),
    )


@query("l04_target_column", """
SELECT f.feature_id, round(coalesce(o.value, 0.0), 6) AS label FROM features f
LEFT JOIN outcome_rows o ON o.feature_id = f.feature_id AND o.target = 'rushing_yards'""", ["features", "outcome_rows"])
def l04(spark, root):
    ml = tr.to_ml_frame(with_outcomes(spark, root), "rushing_yards")
    return rounded(ml.select("feature_id", "label"))


@query("l05_position_targets", "SELECT position, target, count(*) AS n FROM outcome_rows WHERE " + " OR ".join(
    "(position = '{}' AND target IN ({}))".format(p, ", ".join(f"'{t}'" for t in names))
    for p, names in config.POSITION_TARGETS.items()) + " GROUP BY position, target", ["outcome_rows"])
def l05(spark, root):
    return tr.target_rows(with_outcomes(spark, root)).groupBy("position", "target").agg(F.count(F.lit(1)).alias("n"))
