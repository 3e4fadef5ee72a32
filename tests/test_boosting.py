"""Boosted trees against a plain rebuild of every tree, and the stop in flight."""

import math
import random

import numpy as np
import pytest

from fieldsignal.functions import boosting
from fieldsignal.operators import model


def table_of(spark, n=400, parts=3):
    rng = random.Random(n)
    rows = []
    for k in range(n):
        a, b, c = rng.choice([None, *range(9)]), rng.random(), float(rng.randrange(300))
        y = (a or -1) * 2.0 + (10 if b > 0.6 else 0) * (1 if c < 100 else -1) + rng.gauss(0, 0.5)
        rows.append((None if a is None else float(a), b, c, y, "val" if k % 5 == 0 else "test" if k % 7 == 0 else "train"))
    rows += [(1.0, 0.5, 2.0, None, "train"), (1.0, 0.5, 2.0, None, "val")]
    return rows, spark.createDataFrame(rows, "a double, b double, c double, y double, split string").repartition(parts)


def plain_trees(rows, names, rounds, step, leaves, depth, least):
    """The same boosting row by row: open nodes are parted one after the other, the largest gain first."""
    learn = [r for r in rows if r[4] == "train" and r[3] is not None]
    x = [[-math.inf if r[k] is None else r[k] for k in range(3)] for r in learn]
    bounds = []
    for k in range(3):
        known = sorted(r[k] for r in learn if r[k] is not None)
        bounds.append(sorted({known[max(0, math.ceil(len(known) * q / 256) - 1)] for q in range(1, 256)}))
    unit = 2.0 ** (23 - math.ceil(math.log2(max(abs(r[3]) for r in learn))))
    whole = [math.floor(r[3] * unit + 0.5) for r in learn]
    base, score, trees = sum(whole) // len(whole), [0.0] * len(learn), []
    for _ in range(rounds):
        g = [w - base - math.floor(s * unit + 0.5) for w, s in zip(whole, score)]

        def best(members):
            found = None
            for f in range(3):
                for t in bounds[f]:
                    left = [i for i in members if x[i][f] <= t]
                    n, ln = len(members), len(left)
                    if ln < least or n - ln < least:
                        continue
                    s, ls = float(sum(g[i] for i in members)), float(sum(g[i] for i in left))
                    gain = ls * ls / ln + (s - ls) ** 2 / (n - ln) - s * s / n
                    if gain > 0 and (found is None or gain > found[0]):
                        found = gain, f, t
            return found

        members, nodes = {1: list(range(len(learn)))}, {}
        options = {1: best(members[1])}
        while len(members) < leaves:
            open_ = [k for k, o in options.items() if o and k in members]
            if not open_:
                break
            node = max(open_, key=lambda k: (options[k][0], -k))
            _, f, t = nodes[node] = options[node]
            mine = members.pop(node)
            for child, side in ((2 * node, True), (2 * node + 1, False)):
                members[child] = [i for i in mine if (x[i][f] <= t) == side]
                options[child] = best(members[child]) if child.bit_length() <= depth else None
        values = {k: sum(g[i] for i in own) / len(own) / unit for k, own in members.items()}
        for k, own in members.items():
            for i in own:
                score[i] += step * values[k]
        trees.append(({k: (f, t) for k, (_, f, t) in nodes.items()}, values))
    return trees


@pytest.mark.parametrize("leaves, depth", [(6, 7), (31, 3)])
def test_trees_equal_a_plain_rebuild(spark, monkeypatch, leaves, depth):
    monkeypatch.setattr(model, "REWRITE", 2)
    rows, table = table_of(spark)
    fitted = model.train(
        table, ["a", "b", "c"], "y", rounds=4, step=0.5, leaves=leaves, depth=depth, min_leaf_rows=10, column_sample=1.0, patience=9
    )
    expected = plain_trees(rows, ["a", "b", "c"], 4, 0.5, leaves, depth, 10)
    assert len(fitted.model.trees) == 4
    for mine, (nodes, values) in zip(fitted.model.trees, expected):
        assert {k: (mine.feature[k], mine.threshold[k]) for k in mine.feature} == nodes
        own = {k: v for k, v in mine.value.items() if k not in mine.feature}
        assert own == pytest.approx(values)


def test_trees_do_not_depend_on_partitions(spark):
    _, table = table_of(spark)
    params = dict(rounds=3, leaves=8, min_leaf_rows=5)
    one, many = (model.train(t, ["a", "b", "c"], "y", **params) for t in (table.coalesce(1), table.repartition(6)))
    assert [t.threshold for t in one.model.trees] == [t.threshold for t in many.model.trees]
    assert [t.value for t in one.model.trees] == [t.value for t in many.model.trees]


def test_training_stops_in_flight_and_keeps_the_best_round(spark):
    rows, _ = table_of(spark)
    noise = [(r[0], r[1], r[2], random.Random(k).gauss(0, 1), r[4]) for k, r in enumerate(rows)]
    table = spark.createDataFrame(noise, "a double, b double, c double, y double, split string")
    fitted = model.train(table, ["a", "b", "c"], "y", rounds=1000, step=0.5, patience=3, min_leaf_rows=5)
    assert len(fitted.validation_mse) == len(fitted.train_mse) < 40
    assert fitted.best_rounds == int(np.argmin(fitted.validation_mse)) + 1 == len(fitted.validation_mse) - 3
    scored = [r for r in model.predict(fitted.model, table).collect() if r.split == "val"]
    assert np.mean([(r.y - r.prediction) ** 2 for r in scored]) == pytest.approx(min(fitted.validation_mse), rel=1e-4)


def test_row_and_column_samples_change_the_trees_and_are_repeatable(spark):
    _, table = table_of(spark)
    names = ["a", "b", "c"]
    fits = [model.train(table.coalesce(1), names, "y", rounds=2, row_sample=s, leaves=8) for s in (1.0, 0.6, 0.6)]
    roots = [[t.rows[1] for t in f.model.trees] for f in fits]
    assert roots[0][0] == roots[0][1] > roots[1][0] and roots[1] == roots[2] and roots[1][0] != roots[1][1]
    assert {len(model._chosen(names, model.BoostingParams(column_sample=0.67), k)) for k in range(9)} == {2}


def test_train_without_rows_or_validation(spark):
    rows, table = table_of(spark, 100)
    with pytest.raises(ValueError, match="no train rows"):
        model.train(table.where("split = 'val'"), ["a"], "y")
    fitted = model.train(table.where("split = 'train'"), ["a", "b"], "y", rounds=3, min_leaf_rows=5)
    assert fitted.validation_mse == [] and len(fitted.model.trees) == fitted.best_rounds == 3


def test_stop_rule_over_many_curves_equals_the_loop(spark):
    rng = random.Random(1)
    curves = {k: [rng.randrange(9) for _ in range(rng.randrange(1, 30))] for k in range(20)}
    df = spark.createDataFrame([(k, i + 1, float(e)) for k, c in curves.items() for i, e in enumerate(c)], "k int, round int, error double")
    found = {r.k: r.best_round for r in model.kept_rounds(df, ["k"], 4).collect()}
    assert found == {k: model.stop_round(c, 4) for k, c in curves.items()}


def test_best_first_parts_the_largest_open_gain():
    gains = {1: 5.0, 2: 9.0, 3: 6.0, 4: 7.0, 5: 1.0, 6: 8.0, 12: 10.0}
    assert boosting.best_first(gains, 5) == [1, 2, 4, 3] and boosting.best_first(gains, 31) == [1, 2, 4, 3, 6, 12, 5]
    assert boosting.best_first({}, 31) == []


@pytest.mark.parametrize("kind", [np.uint8, np.float64])
def test_leaves_equal_a_walk_of_each_row_and_are_small_numbers(kind):
    rng = np.random.default_rng(2)
    columns = rng.integers(0, 256, (4, 500)).astype(kind)
    feature, limit = np.full(512, -1), np.zeros(512)
    for node in (1, 2, 3, 5, 6, 10, 21, 42, 85):
        feature[node], limit[node] = rng.integers(4), rng.integers(40, 215)
    found = boosting.leaves(columns, feature, limit)
    for row, leaf in enumerate(found):
        node = 1
        while feature[node] >= 0:
            node = 2 * node + int(columns[feature[node], row] > limit[node])
        assert leaf == node
    assert found.dtype == np.uint8 and (boosting.leaves(columns, np.full(4, -1), np.zeros(4)) == 1).all()


def test_rows_of_many_blocks_are_counted_at_once(monkeypatch):
    """A count per block of a few rows would make a histogram for each; the trees are the same for any number."""
    calls, plain = [], boosting.histograms
    monkeypatch.setattr(boosting, "histograms", lambda *x: calls.append(x[0].shape[1]) or plain(*x))
    one = BoostingPass()
    for limit, expected in ((10_000, 1), (1, 6)):
        monkeypatch.setattr(model, "HISTOGRAM_ROWS", limit)
        calls.clear()
        made = [batch.to_pylist() for batch in one.run()]
        assert len(calls) == expected and sum(calls) == 60
        assert limit == 10_000 or made == first
        first = made


class BoostingPass:
    """One pass over six blocks of ten rows each, without Spark."""

    def __init__(self):
        import pyarrow as pa

        rng = np.random.default_rng(1)
        blocks = [
            ("train", 10, rng.integers(0, 256, (2, 10)).astype(np.uint8).tobytes(), rng.integers(-99, 99, 10).tobytes(),
             np.zeros(10).tobytes()) for _ in range(6)
        ]
        names = ["part", "n", "bins", "label", "score"]
        self.batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*blocks)], names=names)

    def run(self):
        leaf = np.full(4, -1), np.zeros(4)
        one = model._Pass(0, 1.0, 0.1, [], leaf, np.array([1]), [0, 1], 2, 1.0, 0, 1, False)
        return list(one.count(iter([self.batch])))


def test_bounds_of_each_feature_are_its_own(spark):
    """Features are grouped apart; one without readings has no bounds."""
    df = spark.createDataFrame([(float(k), float(k % 3), None) for k in range(600)], "a double, b double, c double")
    (a, b, c), n = model.cuts(df.repartition(4), ["a", "b", "c"])
    assert n == 600 and len(a) == 255 and list(b) == [0.0, 1.0, 2.0] and not len(c)
    assert list(a[:3]) == [math.ceil(600 * q / 256) - 1 for q in (1, 2, 3)]


def test_contributions_leave_python_as_one_row_each(spark):
    """Rows are taken apart by feature in Spark; before, Python made a row with a name for each feature."""
    from fieldsignal.operators import attribute
    from fieldsignal.spec import SeriesSpec

    tree = boosting.Tree({1: 0}, {1: 0}, {1: 5.0}, {1: 0.0, 2: -1.0, 3: 3.0}, {1: 4, 2: 3, 3: 1}, {1: 1.0})
    fitted = model.Fitted(model.BoostedTrees(["a", "b"], 10.0, 0.5, [tree]), [], [], 1)
    df = spark.createDataFrame([("s", 0, 4.0, None), ("s", 1, 6.0, 2.0)], "series_id string, row_idx long, a double, b double")
    made = attribute.contributions(df, fitted, SeriesSpec())
    assert made.columns == ["series_id", "row_idx", "feature", "value", "contribution", "base_value"]
    assert [tuple(r) for r in made.orderBy("row_idx", "feature").collect()] == [
        ("s", 0, "a", 4.0, -0.5, 10.0), ("s", 0, "b", None, 0.0, 10.0), ("s", 1, "a", 6.0, 1.5, 10.0), ("s", 1, "b", 2.0, 0.0, 10.0),
    ]
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" in plan and "MapInArrow" in plan
