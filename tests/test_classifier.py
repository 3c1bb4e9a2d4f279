"""The direction forest: its answers from its trees, held-out accuracy, and its split."""

from __future__ import annotations

import datetime as dt
import random

from sparksignal import schemas
from sparksignal.plans import classifier
from sparksignal.session import scratch_path
from sparksignal.sources import versioned


def _features(spark, n, seed=1):
    """Days whose next direction follows from the sign of ``price_delta`` but for a tenth of them."""
    rng, rows, names = random.Random(seed), [], schemas.FEATURES.fieldNames()
    for i in range(n):
        row = dict.fromkeys(names, 0.0) | {c: rng.uniform(-1, 1) for c in classifier.FEATURE_COLS}
        up = row["price_delta"] > 0
        row |= {"date": dt.date(2020, 1, 1) + dt.timedelta(days=i), "volume": 1, "war_article_count": 1, "favor_count": 1, "against_count": 1,
                "price_direction": int(up if rng.random() > .1 else not up)}
        rows.append(tuple(row[c] for c in names))
    return spark.createDataFrame(rows, schemas.FEATURES)


def _walk(node, values):
    while node.subtreeDepth() > 0:
        s = node.split()
        node = node.leftChild() if values[s.featureIndex()] <= s.threshold() else node.rightChild()
    stats = list(node.impurityStats().stats())
    return [x / sum(stats) for x in stats]


def test_predictions_are_the_mean_of_the_trees(spark):
    f = _features(spark, 200)
    train, test = classifier.split_chronological(f)
    model = classifier.train(train, num_trees=15)
    trees = [t._java_obj.rootNode() for t in model.stages[-1].trees]
    rows = {r["date"]: [float(r[c]) for c in classifier.FEATURE_COLS] for r in test.collect()}
    for r in classifier.predict(model, test).collect():
        votes = [_walk(t, rows[r["date"]]) for t in trees]
        up = sum(v[1] for v in votes) / len(votes)
        assert r["prediction_numeric"] == int(up > 0.5) and r["prediction"] == ("Up" if up > 0.5 else "Down")
        assert abs(r["confidence"] - max(up, 1 - up)) <= 1e-4
    latest = classifier.latest_prediction(model, f).collect()
    assert len(latest) == 1 and latest[0]["date"] == max(rows)
    assert [round(x, 4) for x in rows[max(rows)]] == [latest[0]["features"][c] for c in classifier.FEATURE_COLS]


def test_a_forest_after_an_observed_write(spark):
    versioned.publish(spark.range(3), scratch_path(spark, "observed"))
    train, test = classifier.split_chronological(_features(spark, 60))
    assert classifier.predict(classifier.train(train), test).count() == 12


def test_held_out_accuracy(spark):
    f = _features(spark, 600, seed=2)
    train, test = classifier.split_chronological(f)
    assert (train.count(), test.count()) == (480, 120)
    got = classifier.predict(classifier.train(train), test).collect()
    assert sum(r["actual"] == r["prediction_numeric"] for r in got) / len(got) > 0.8  # a tenth of the labels is noise
    assert all(0.5 <= r["confidence"] <= 1 for r in got)
    again = classifier.predict(classifier.train(train), test).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))  # the seed fixes the forest
