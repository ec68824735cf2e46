"""DuckDB text of the derived tables, the counterpart of sources.stand_ins."""

from __future__ import annotations

_POSITION = """CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'QB' WHEN 'BUILDING' THEN 'RB'
  WHEN 'FURNITURE' THEN 'WR' WHEN 'HOUSEHOLD' THEN 'TE' WHEN 'MACHINERY' THEN 'K' ELSE 'DEF' END"""
_OPP = "((week - {t}) % 25 + 25) % 25"

_COUNTS = (
    "lines attempts completions passing_tds passing_interceptions sacks_suffered carries "
    "rushing_tds targets receptions receiving_tds fg_att fg_made pat_att pat_made "
    "def_tackles_solo"
).split()
_AMOUNTS = (
    "quantity passing_yards passing_epa rushing_yards rushing_epa receiving_yards receiving_epa"
).split()

# name -> (tables it needs, body)
TABLES: dict[str, tuple[tuple[str, ...], str]] = {
    "order_periods": ((), """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       CAST(year(o_orderdate) AS INTEGER) AS season, CAST(month(o_orderdate) AS INTEGER) AS week,
       CAST(floor(o_totalprice / 1000) AS BIGINT) AS pts
FROM orders"""),
    "order_lines": ((), """
SELECT l_orderkey,
  count(*) AS lines,
  sum(l_quantity) AS quantity,
  count(*) FILTER (l_returnflag <> 'R') AS attempts,
  count(*) FILTER (l_returnflag <> 'R' AND l_linestatus = 'O') AS completions,
  coalesce(sum(l_quantity) FILTER (l_returnflag <> 'R'), 0.0) AS passing_yards,
  count(*) FILTER (l_returnflag <> 'R' AND l_quantity > 45) AS passing_tds,
  count(*) FILTER (l_returnflag <> 'R' AND l_suppkey % 20 = 0) AS passing_interceptions,
  coalesce(sum((round(l_discount * 100) - 5) / 4) FILTER (l_returnflag <> 'R'), 0.0) AS passing_epa,
  count(*) FILTER (l_returnflag <> 'R' AND round(l_discount * 100) = 10) AS sacks_suffered,
  count(*) FILTER (l_returnflag = 'R') AS carries,
  coalesce(sum(l_quantity) FILTER (l_returnflag = 'R'), 0.0) AS rushing_yards,
  count(*) FILTER (l_returnflag = 'R' AND l_quantity > 45) AS rushing_tds,
  coalesce(sum((round(l_discount * 100) - 5) / 4) FILTER (l_returnflag = 'R'), 0.0) AS rushing_epa,
  count(*) FILTER (l_returnflag = 'N') AS targets,
  count(*) FILTER (l_returnflag = 'N' AND l_linestatus = 'O') AS receptions,
  coalesce(sum(l_quantity) FILTER (l_returnflag = 'N' AND l_linestatus = 'O'), 0.0) AS receiving_yards,
  count(*) FILTER (l_returnflag = 'N' AND l_linestatus = 'O' AND l_quantity > 45) AS receiving_tds,
  coalesce(sum((round(l_discount * 100) - 5) / 4) FILTER (l_returnflag = 'N'), 0.0) AS receiving_epa,
  count(*) FILTER (l_partkey % 3 = 0) AS fg_att,
  count(*) FILTER (l_partkey % 3 = 0 AND l_linestatus = 'O') AS fg_made,
  count(*) FILTER (l_partkey % 4 = 0) AS pat_att,
  count(*) FILTER (l_partkey % 4 = 0 AND l_linestatus <> 'O') AS pat_made,
  count(*) FILTER (l_suppkey % 2 = 0) AS def_tackles_solo
FROM lineitem GROUP BY l_orderkey"""),
    "player_totals": (("order_periods", "order_lines"), """
SELECT o_custkey, season, week, sum(o_totalprice) AS spend, CAST(sum(pts) AS DOUBLE) AS fantasy_points, count(*) AS orders,
""" + ",\n".join(f"  CAST(coalesce(sum({c}), 0) AS BIGINT) AS {c}" for c in _COUNTS) + ",\n"
        + ",\n".join(f"  CAST(coalesce(sum({c}), 0.0) AS DOUBLE) AS {c}" for c in _AMOUNTS) + """
FROM order_periods LEFT JOIN order_lines ON o_orderkey = l_orderkey
GROUP BY o_custkey, season, week"""),
    "player_games": (("player_totals",), f"""
SELECT *, fantasy_points + receptions AS fantasy_points_ppr FROM (
SELECT o_custkey AS player_id, c_name AS player_name, {_POSITION} AS position, season, week,
  CASE WHEN week = 12 THEN 'POST' ELSE 'REG' END AS season_type,
  c_nationkey AS team, {_OPP.format(t='c_nationkey')} AS opponent_team,
  orders, spend, {', '.join(_COUNTS + _AMOUNTS)},
  CASE WHEN fg_att <> 0 THEN fg_made / CAST(fg_att AS DOUBLE) END AS fg_pct,
  CASE WHEN lines <> 0 THEN targets / CAST(lines AS DOUBLE) END AS target_share,
  CASE WHEN quantity <> 0 THEN receiving_yards / quantity END AS air_yards_share,
  fantasy_points
FROM player_totals JOIN customer ON o_custkey = c_custkey)
WHERE opponent_team <> team"""),
    "order_games": (("order_periods",), f"""
SELECT o_custkey AS player_id, c_name AS player_name, {_POSITION} AS position, season, week,
  CASE WHEN week = 12 THEN 'POST' ELSE 'REG' END AS season_type,
  c_nationkey AS team, {_OPP.format(t='c_nationkey')} AS opponent_team,
  orders, spend, first_status, fantasy_points
FROM (SELECT o_custkey, season, week, sum(o_totalprice) AS spend, CAST(sum(pts) AS DOUBLE) AS fantasy_points, count(*) AS orders,
             min(o_orderstatus) AS first_status
      FROM order_periods GROUP BY o_custkey, season, week)
JOIN customer ON o_custkey = c_custkey"""),
    "team_stats": (("player_games",), """
SELECT team, season, week, season_type, opponent_team,
""" + ",\n".join(f"  CAST(sum({c}) AS BIGINT) AS {c}" for c in _COUNTS if c != "lines") + ",\n"
        + ",\n".join(f"  sum({c}) AS {c}" for c in _AMOUNTS if c != "quantity") + """,
  sum(fantasy_points) AS fantasy_points
FROM player_games GROUP BY team, season, week, season_type, opponent_team"""),
    "team_sides": (("order_periods",), f"""
SELECT g.team, g.season, g.week, g.opponent_team,
  7 * (g.week - lag(g.week) OVER (PARTITION BY g.team, g.season ORDER BY g.week)) AS rest,
  CAST(g.region = o.n_regionkey AS INTEGER) AS div_game,
  coalesce(p.points, 0) AS points
FROM (SELECT n_nationkey AS team, n_regionkey AS region, season, week,
             {_OPP.format(t='n_nationkey')} AS opponent_team
      FROM nation, (SELECT DISTINCT season, week FROM order_periods)) g
JOIN nation o ON o.n_nationkey = g.opponent_team
LEFT JOIN (SELECT c_nationkey AS team, season, week, count(*) AS points
           FROM order_periods JOIN customer ON o_custkey = c_custkey
           GROUP BY c_nationkey, season, week) p
  ON p.team = g.team AND p.season = g.season AND p.week = g.week
WHERE g.opponent_team <> g.team"""),
    "schedule": (("team_sides",), """
SELECT h.season || '_' || h.week || '_' || h.team || '_' || a.team AS game_id, h.season,
  CASE WHEN h.week = 12 THEN 'POST' ELSE 'REG' END AS game_type, h.week,
  make_date(h.season, h.week, h.team % 7 + 1) AS gameday,
  h.team AS home_team, h.points AS home_score, h.rest AS home_rest,
  a.team AS away_team, a.points AS away_score, a.rest AS away_rest, h.div_game
FROM team_sides h JOIN team_sides a
  ON a.team = h.opponent_team AND a.season = h.season AND a.week = h.week
WHERE h.team < h.opponent_team"""),
    "team_games": (("schedule",), """
SELECT game_id, season, game_type, week, gameday, div_game, home_team AS team,
  away_team AS opponent_team, 'home' AS game_role, home_rest AS rest,
  home_score AS points, away_score AS points_against FROM schedule
UNION ALL
SELECT game_id, season, game_type, week, gameday, div_game, away_team, home_team, 'away',
  away_rest, away_score, home_score FROM schedule"""),
    "plays": (("order_periods",), f"""
SELECT season || '_' || week || '_' || least(posteam, defteam) || '_' || greatest(posteam, defteam) AS game_id,
  season, week, CASE WHEN week = 12 THEN 'POST' ELSE 'REG' END AS season_type, posteam, defteam,
  l_orderkey AS drive, drive_play_count,
  CAST(l_orderkey % 8 AS VARCHAR) || ':' || lpad(CAST(l_orderkey % 60 AS VARCHAR), 2, '0') AS drive_time_of_possession,
  l_linenumber AS down, l_quantity AS yards_gained, l_quantity AS yardline_100,
  (round(l_discount * 100) - 5) / 4 AS epa,
  CAST(l_linestatus = 'O' AS INTEGER) AS success,
  CAST(l_returnflag = 'R' AS INTEGER) AS touchdown,
  CASE WHEN l_returnflag = 'R' THEN 'run' ELSE 'pass' END AS play_type, 1 AS play,
  CAST(l_returnflag <> 'R' AS INTEGER) AS pass_attempt,
  CAST(l_returnflag = 'R' AS INTEGER) AS rush_attempt,
  CAST(round(l_discount * 100) >= 9 AS INTEGER) AS qb_hit,
  CAST(round(l_discount * 100) = 10 AS INTEGER) AS sack,
  CAST(l_suppkey % 20 = 0 AS INTEGER) AS interception,
  CAST(l_partkey % 25 = 0 AS INTEGER) AS fumble_lost,
  CAST(l_linenumber = 3 AND l_linestatus = 'O' AS INTEGER) AS third_down_converted,
  CAST(l_linenumber = 3 AND l_linestatus <> 'O' AS INTEGER) AS third_down_failed,
  CAST(round(l_tax * 200) AS INTEGER) - 8 AS score_differential,
  CAST(l_partkey % 900 AS INTEGER) AS quarter_seconds_remaining
FROM (SELECT o_orderkey, season, week, c_nationkey AS posteam,
             {_OPP.format(t='c_nationkey')} AS defteam
      FROM order_periods JOIN customer ON o_custkey = c_custkey) d
JOIN lineitem ON l_orderkey = o_orderkey
JOIN (SELECT l_orderkey AS k, count(*) AS drive_play_count FROM lineitem GROUP BY l_orderkey) s ON s.k = o_orderkey
WHERE defteam <> posteam"""),
    "rosters": (("order_games",), """
SELECT season, team, week, player_id AS gsis_id, player_name AS full_name, position,
  position AS depth_chart_position, CAST(player_id % 99 + 1 AS INTEGER) AS jersey_number,
  CASE first_status WHEN 'O' THEN 'ACT' WHEN 'F' THEN 'RES' ELSE 'CUT' END AS status,
  season - 1995 AS years_exp, CAST(66 + player_id % 15 AS VARCHAR) AS height,
  CAST(170 + player_id % 150 AS INTEGER) AS weight
FROM order_games"""),
    "depth_charts": (("rosters",), """
SELECT season, team AS club_code, week, CAST(1 + gsis_id % 3 AS VARCHAR) AS depth_team,
  split_part(full_name, '#', 2) AS last_name, split_part(full_name, '#', 1) AS first_name,
  'Offense' AS formation, gsis_id, position
FROM rosters WHERE week > 1"""),
    "players": ((), f"""
SELECT c_custkey AS player_id, c_custkey AS gsis_id, 'E' || c_custkey AS espn_id, c_name AS player_name,
  {_POSITION} AS position, CASE WHEN c_custkey % 3 <> 0 THEN {_POSITION} END AS position_group,
  CAST(1995 + c_custkey % 4 AS INTEGER) AS draft_year, CAST(1 + c_custkey % 7 AS INTEGER) AS draft_round,
  CAST(1 + c_custkey % 32 AS INTEGER) AS draft_pick, n_name AS college,
  CASE WHEN c_acctbal < 0 THEN 'RET' ELSE 'ACT' END AS status
FROM customer JOIN nation ON c_nationkey = n_nationkey"""),
}


def add_table(name: str, needs: tuple[str, ...], body: str) -> None:
    """Make a further derived table available to ``with_tables``."""
    TABLES[name] = (needs, body)


def with_tables(needs, body: str) -> str:
    """``body`` preceded by every derived table it needs, in dependency order."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        for dep in TABLES[name][0]:
            visit(dep)
        ordered.append(name)

    for n in needs:
        visit(n)
    if not ordered:
        return body.strip()
    ctes = ",\n".join(f"{n} AS ({TABLES[n][1].strip()})" for n in ordered)
    body = body.strip()
    if body[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
