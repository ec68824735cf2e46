"""Player form and matchup context in one flow."""

from __future__ import annotations

from pyspark.sql import DataFrame

from weekfold import config
from weekfold.operators import form, matchup
from weekfold.operators.windows import MEASURES

PER_PLAYER = [c for c in matchup.CONTEXT if c not in ("opp_rank_vs_position", "opp_allowed")]


def player_features(
    stats: DataFrame,
    schedule: DataFrame,
    team_stats: DataFrame,
    columns=None,
    windows=config.ROLLING_WINDOWS,
    measures=MEASURES,
    trends_only: bool = False,
) -> DataFrame:
    """Rolling form, composite trends and matchup context per player and week.

    Same rows and columns as joining ``rolling_features`` with ``context``, but
    without that join: splits, history and form are windows over the same
    player partitioning, so the statistics are shuffled by player once. Splits
    and history see all games; the form keeps the regular season, which is a
    filter between the windows. Opponent strength, a table sized by the
    calendar, is attached last.
    """
    placed = matchup.with_history(matchup.with_splits(matchup.with_game(stats, schedule)))
    rolled = form.composite_trends(
        form.rolling_features(
            placed, columns, windows, measures, trends_only=trends_only,
            keep=["opponent_team", *PER_PLAYER],
        )
    )
    return matchup.with_opponent(rolled, stats, team_stats).drop("opponent_team")
