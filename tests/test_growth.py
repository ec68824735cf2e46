"""Growth of trees over many rows: sums, shares of work, cuts, and rows that are asked about."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from weekfold.operators import boosting as bo
from weekfold.operators import histograms as hi
from weekfold.operators import selection as sel
from weekfold.operators import training as tr


def plain_sums(bins, rows, g, h):
    out = np.zeros((bins.shape[1], hi.BINS, 3))
    for r in rows:
        for j, b in enumerate(bins[r]):
            out[j, b] += (g[r], 1.0 if h is None else h[r], 1)
    return out


@pytest.mark.parametrize("weighted", [False, True])
@pytest.mark.parametrize("many", [1, 10**9])
def test_sums_by_codes_and_by_features(monkeypatch, many, weighted):
    rng = np.random.default_rng(3)
    sizes = [32, 1, 7, 30, 2, 32, 3]
    bins = np.stack([rng.integers(0, k, 900) for k in sizes], axis=1).astype(np.uint8)
    scale = 2.0 ** 20
    g = np.rint(rng.normal(size=900) * 30 * scale) / scale
    h = np.rint(rng.random(900) * scale) / scale if weighted else None
    monkeypatch.setattr(hi, "MANY_ROWS", many)
    monkeypatch.setattr(hi, "_PIECE", 256)
    monkeypatch.setattr(hi, "_NODES", 2)
    lists = [np.arange(900), rng.permutation(900)[:300], np.zeros(0, dtype=int), np.array([5, 5, 6])]
    got = hi.Rows(bins, sizes).sums(lists, g, h, scale)
    for rows, one in zip(lists, got):
        assert one.tobytes() == plain_sums(bins, rows, g, h).tobytes()


def test_sums_of_large_gradients_are_exact():
    """Gradients that leave no room for a count in the same number of many rows."""
    bins = np.zeros((5_000, 2), dtype=np.uint8)
    g = np.full(5_000, float(2**40 - 1))
    got = hi.Rows(bins, [1, 1]).sums([np.arange(5_000)], g, None, 1.0)
    assert got[0, 0, 0].tolist() == [5_000.0 * (2**40 - 1), 5_000.0, 5_000.0]


def test_rows_sent_down_several_trees_at_once(monkeypatch):
    rng = np.random.default_rng(4)
    bins = rng.integers(0, 32, (700, 5)).astype(np.uint8)
    label = bins[:, 0] + 3.0 * (bins[:, 1] > 9) + rng.normal(size=700)
    frame = bo.Frame([np.arange(31.0)] * 5, 2.0 ** 15, 700, {0: (700, float(label.sum()))})
    spec = bo.specified({"f": frame}, "m", "f", bo.Settings(depth=4, trees=9, rows=0.7, rate=0.3))
    nodes = bo._grown(spec, frame, bo.Rows(bins, [32] * 5), label, np.arange(700), np.zeros(700), np.zeros(0, dtype=bo.NODE))
    trees = bo.split_trees(nodes)
    assert len(trees) == 9
    want = np.full(700, spec.base)
    for number, tree in enumerate(trees):
        want = want + (1.0 if number == 0 else 0.3) * tree["value"][bo.reached(tree, bins)]
    monkeypatch.setattr(hi, "_SENT", 4_096)
    assert bo._add(np.full(700, spec.base), bins, trees, spec.settings).tobytes() == want.tobytes()
    # grown on from some trees as in one go
    first = np.concatenate(trees[:4])
    again = bo._grown(spec, frame, bo.Rows(bins, [32] * 5), label, np.arange(700), np.zeros(700), first)
    assert again.tobytes() == nodes.tobytes()


def wide(spark, n):
    x = (F.col("id") * 7919 % 1009).cast("double")
    return spark.range(n).select(
        F.col("id").cast("string").alias("feature_id"), F.lit("a").alias("model"),
        F.array(x, F.col("id") % 13 * 1.0, F.lit(1.0)).alias("features"), (x / 10 + F.col("id") % 13).alias("label"),
    )


def test_a_model_of_many_rows_takes_no_job_for_each_level(spark, monkeypatch):
    def never(*_):
        raise AssertionError("a job for each level")

    monkeypatch.setattr(bo, "_grow_far", never)
    df = wide(spark, 60_000)
    model = bo.fit(df, bo.Settings(depth=4, trees=4))
    assert model.trees("a") == 4 and model.nodes["a"]["rows"][0] == 60_000
    error, spread = model.transform(df).agg(
        F.avg((F.col("label") - F.col("prediction")) ** 2), F.var_pop("label")
    ).first()
    assert error < 0.1 * spread


def test_shares_of_work_are_bounded_by_tasks_not_models():
    frames = {f: bo.Frame([np.empty(0)] * 3, 1.0, n, {0: (n, 0.0)}) for f, n in (("a", 900), ("b", 100), ("c", 1))}
    specs = [bo.specified(frames, f"{f}/{i}", f, bo.Settings(trees=10 + i)) for f in frames for i in range(50)]
    shares = bo._shares(specs, frames, {s.name: 0 for s in specs}, 12)
    assert len(shares) <= 12 + len(frames)
    assert sorted(s.name for own in shares for s in own) == sorted(s.name for s in specs)
    assert all(len({s.frame for s in own}) == 1 for own in shares)


def test_cuts_are_exact(spark):
    number = F.col("feature_id").cast("long")
    df = wide(spark, 12_000).withColumn("features", F.array(
        F.col("features")[0], F.when(number % 5 != 0, F.col("features")[1]), F.col("features")[2],
        F.when(number % 2 == 0, F.lit(float("nan"))).otherwise(number.cast("double")),
    ))
    values = np.array([r.features for r in df.select("features").collect()], dtype=float)
    for parts in (1, 7):
        rows = bo.frame_rows(df.repartition(parts), "model")
        cuts = bo.frames_of(rows)["a"].cuts
        for j, own in enumerate(cuts):
            column = np.sort(values[:, j][~np.isnan(values[:, j])])
            ranks = [math.ceil(k * len(column) / bo.BINS) for k in range(1, bo.BINS)]
            assert own.tolist() == sorted({column[r - 1] for r in ranks})


def test_models_of_the_same_features_share_cuts(spark, monkeypatch):
    seen = []
    found = bo._cuts
    monkeypatch.setattr(bo, "_cuts", lambda df: seen.append({r.frame for r in df.select("frame").distinct().collect()}) or found(df))
    one = wide(spark, 300)
    df = one.withColumn("model", F.lit("a/x")).unionByName(
        one.withColumn("model", F.lit("a/y")).withColumn("label", -F.col("label"))
    ).unionByName(one.limit(200).withColumn("model", F.lit("b/x")))
    alone = bo.fit(df, bo.Settings(depth=2, trees=2))
    shared = bo.fit(df, bo.Settings(depth=2, trees=2), alike=lambda name: name.split("/")[0])
    assert len(seen[0]) == 3 and len(seen[1]) == 2 and "b/x" in seen[1]
    assert all(alone.nodes[m].tobytes() == shared.nodes[m].tobytes() for m in ("a/x", "a/y", "b/x"))


def test_a_fold_is_asked_about_its_own_rows_only(spark, monkeypatch):
    asked = []
    given = bo.Models.scores

    def scores(self, *args):
        out = given(self, *args)
        asked.append(out.count())
        return out

    monkeypatch.setattr(bo.Models, "scores", scores)
    df = wide(spark, 300).withColumn("fold", (F.col("feature_id").cast("int") % 3).cast("int"))
    got = sel.fold_scores(df, tr.tree_settings(trees=2, depth=2), folds=3).collect()
    assert asked == [300] and sorted((r.fold, r.fitted, r.n) for r in got) == [(k, 200, 100) for k in range(3)]
