"""Stage tables shared by the dataset queries.

Stages are written once per session to the shared folder and read back, the
way a scheduled run hands one stage's table to the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from weekfold.operators import form, lifecycle, quality, targets, team, temporal
from weekfold.plans import dataset, player
from weekfold.session import settle
from weekfold.sources import stand_ins as src

PLAYS_FROM = 1998
_built: dict = {}


def stamp(spark, root) -> tuple:
    """Names, sizes and times of the tables in a folder: another value once one of them has changed."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return tuple(sorted(
        (s.getPath().getName(), fs.getContentSummary(s.getPath()).getLength(), s.getModificationTime())
        for s in fs.listStatus(path)
    ))


def kept(spark, root, name, build):
    """What ``build`` returns (models, whose size the settings bound), kept while the tables are unchanged."""
    key = (spark.sparkContext.applicationId, root, name)
    now = stamp(spark, root)
    if key not in _built or _built[key][0] != now:
        _built[key] = now, build()
    return _built[key][1]


def stage(spark, root, name, build):
    """A stage table of the tables in ``root``, built again when they have changed."""
    return kept(spark, root, name, lambda: settle(build(), name.replace(" ", "-")))


def games(spark, root):
    return stage(spark, root, "player_games", lambda: src.player_games(spark, root))


def schedule(spark, root):
    return stage(spark, root, "schedule", lambda: src.schedule(spark, root))


def team_stats(spark, root):
    return src.team_totals(games(spark, root))


def player_features(spark, root):
    """Rolling form, composite trends and matchup context."""
    wanted = list(dict.fromkeys([*dataset.vector_stats(), *form.trend_stats()]))
    built = player.player_features(
        games(spark, root), schedule(spark, root), team_stats(spark, root),
        wanted, measures=("avg",), trends_only=True,
    )
    return built.select(*[c for c in built.columns if "_trend_" not in c])


def features(spark, root):
    """The assembled vectors."""
    def build():
        stats = games(spark, root)
        lives = lifecycle.lifecycle(src.players(spark, root), src.rosters(spark, root), stats)
        teams = team.team_aggregates(src.plays(spark, root), team_stats(spark, root), PLAYS_FROM)
        return dataset.assemble(
            stats, schedule(spark, root), player_features(spark, root), teams,
            lifecycle.experience(stats, lives),
        )

    return stage(spark, root, "features", build)


def scored(spark, root):
    return quality.score_quality(features(spark, root))


def with_outcomes(spark, root, played=None) -> DataFrame:
    """Scored features with their targets; ``played`` limits which are known."""
    rows = scored(spark, root)
    known = rows if played is None else rows.filter(played)
    return targets.with_targets(rows, targets.targets(known, games(spark, root), schedule(spark, root)))


def training(spark, root):
    """Scored features with targets and split, as stored for training."""
    return stage(spark, root, "training", lambda: temporal.temporal_split(with_outcomes(spark, root)))
