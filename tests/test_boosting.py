"""Softmax boosting against a plain version, and its early stop."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from moodlens.operators import boosting

ROWS, CLASSES, FEATURES = 400, 3, 4


@pytest.fixture(scope="module")
def table():
    rng = np.random.default_rng(4)
    x = np.round(rng.normal(size=(ROWS, FEATURES)), 1)
    y = ((x[:, 0] + x[:, 1] ** 2 > 0.5).astype(int) + (x[:, 2] > 0.7)).clip(0, 2)
    noise = rng.random(ROWS) < 0.1
    y[noise] = rng.integers(0, 3, noise.sum())
    return x, y, rng.choice([0.5, 1.0, 2.0], ROWS), rng.random(ROWS) < 0.25


@pytest.fixture(scope="module")
def rows(spark, table):
    x, y, w, held = table
    data = [(i, int(y[i]), [float(v) for v in x[i]], float(w[i]), bool(held[i])) for i in range(ROWS)]
    return spark.createDataFrame(data, "review_id long, label int, features array<double>, weight double, held boolean").repartition(5).cache()


def plain(x, y, w, edges, o):
    """All rows and features, one tree per class and round, grown cut by cut."""
    margins = np.zeros((len(x), CLASSES))
    for _ in range(o.rounds):
        p = boosting.softmax(margins)
        change = np.zeros_like(margins)
        for c in range(CLASSES):
            g, h = w * (p[:, c] - (y == c)), w * 2 * p[:, c] * (1 - p[:, c])

            def grow(mine, depth, c=c, g=g, h=h):
                best, total = (1e-12, None), g[mine].sum() ** 2 / (h[mine].sum() + o.l2)
                for f in range(FEATURES) if depth else ():
                    for cut in edges[f]:
                        a, b = mine & (x[:, f] <= cut), mine & (x[:, f] > cut)
                        if min(h[a].sum(), h[b].sum()) < o.min_child:
                            continue
                        gain = g[a].sum() ** 2 / (h[a].sum() + o.l2) + g[b].sum() ** 2 / (h[b].sum() + o.l2) - total
                        if gain > best[0] * (1 + 1e-9):
                            best = gain, (a, b)
                if best[1] is None:
                    change[mine, c] = -o.step * g[mine].sum() / (h[mine].sum() + o.l2)
                else:
                    grow(best[1][0], depth - 1)
                    grow(best[1][1], depth - 1)

            grow(np.ones(len(x), bool), o.max_depth)
        margins += change
    return boosting.softmax(margins)


@pytest.mark.parametrize("weighted", [False, True])
def test_same_as_plain_version(rows, table, weighted):
    x, y, w, _ = table
    o = boosting.BoostOptions(rounds=12, max_depth=3, step=0.3, row_share=1.0, feature_share=1.0, l2=0.7, bins=16)
    model = boosting.fit_boosting(rows, CLASSES, o, "weight" if weighted else None)
    edges = boosting.bin_edges(rows, FEATURES, o.bins)
    want = plain(x, y, w if weighted else np.ones(ROWS), edges, o)
    got = {r["review_id"]: r["probability"] for r in model.predict(rows).collect()}
    # twelve rounds: the margins were written anew once
    assert np.allclose([got[i] for i in range(ROWS)], want, atol=1e-9)
    assert model.rounds == 12 and sum(model.importances()) == pytest.approx(1.0)


def test_sums_in_two_steps(rows, monkeypatch):
    o = boosting.BoostOptions(rounds=3, max_depth=3)
    once = boosting.fit_boosting(rows, CLASSES, o).predict(rows)
    monkeypatch.setattr(boosting, "GROUP", 2)
    twice = boosting.fit_boosting(rows.repartition(9), CLASSES, o).predict(rows)
    a, b = ({r["review_id"]: r["probability"] for r in m.collect()} for m in (once, twice))
    assert all(np.allclose(a[i], b[i], atol=1e-9) for i in a)


def test_stops_at_the_least_held_out_loss(rows, table):
    x, y, _, held = table
    o = boosting.BoostOptions(rounds=60, max_depth=4, step=0.4, patience=4)
    model = boosting.fit_boosting(rows, CLASSES, o, None, "held")
    fitted = len(model.losses)
    assert model.rounds == int(np.argmin(model.losses)) + 1 and fitted in (model.rounds + 4, 60)
    p = np.array([r["probability"] for r in model.predict(rows.where("held")).orderBy("review_id").collect()])
    loss = -np.log(p[np.arange(held.sum()), y[held]]).mean()
    assert loss == pytest.approx(min(model.losses))
    assert (p.argmax(axis=1) == y[held]).mean() > 0.7


def test_sampling_and_regularisation(rows):
    shares = boosting.BoostOptions(rounds=2, max_depth=2, row_share=0.5, feature_share=0.5)
    first, again = (boosting.fit_boosting(rows, CLASSES, shares) for _ in range(2))
    assert all((a.value == b.value).all() for g, h in zip(first.trees, again.trees) for a, b in zip(g, h))
    strong = boosting.fit_boosting(rows, CLASSES, boosting.BoostOptions(rounds=2, max_depth=2, l2=1000.0))
    weak = boosting.fit_boosting(rows, CLASSES, boosting.BoostOptions(rounds=2, max_depth=2, l2=0.0))
    size = lambda m: max(np.abs(t.value).max() for g in m.trees for t in g)
    assert size(strong) < size(weak) / 10
    draws = np.random.default_rng(0).integers(-(1 << 62), 1 << 62, 20_000)
    one, two = (boosting._chosen(draws, k, 0.8, 42) for k in (1, 2))
    assert abs(one.mean() - 0.8) < 0.01 and abs((one & two).mean() - 0.64) < 0.01


def test_features_of_one_value_and_no_rows(spark, rows):
    flat = rows.withColumn("features", F.array(F.lit(1.0), F.lit(2.0)))
    model = boosting.fit_boosting(flat, CLASSES, boosting.BoostOptions(rounds=2, max_depth=2, row_share=1.0))
    assert model.importances() == [0.0, 0.0]
    assert model.predict(flat).select("prediction").distinct().count() == 1
    with pytest.raises(ValueError, match="needs rows"):
        boosting.fit_boosting(rows.where("false"), CLASSES)


def test_saved_model(rows, tmp_path):
    model = boosting.fit_boosting(rows, CLASSES, boosting.BoostOptions(rounds=3, max_depth=3, patience=1), None, "held")
    model.save(str(tmp_path / "m"))
    back = boosting.Boosting.load(str(tmp_path / "m"))
    a, b = ({r["review_id"]: r["probability"] for r in m.predict(rows).collect()} for m in (model, back))
    assert a == b and back.losses == model.losses and back.importances() == model.importances()
