"""Quality rules and the additive quality model."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from hazardflow.llm import gam_quality, quality_rules
from hazardflow.llm.store import crc_fold

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    text = text or ""
    w = WORD.findall(text)
    windows = {}
    for i in range(len(w) - 7):
        windows.setdefault(tuple(w[i : i + 8]), []).append(i)
    inside = {k for places in windows.values() if len(places) > 1 for i in places for k in range(i, i + 8)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside))


def test_counts_equal_plain_python(corpus):
    rows = corpus.collect()
    names = quality_rules.COUNTS[:5]
    got = quality_rules.apply(corpus, []).collect()
    key = lambda r: (r[0] is None, r)
    want = []
    for r in rows:
        c = counts(r.text)
        failed = c[0] < 20 or 100 * c[4] > 30 * c[0]
        want.append((-1 if r.doc_id is None else r.doc_id, *c, failed, not failed))
    assert sorted(map(key, want)) == sorted(
        key((-1 if r.doc_id is None else r.doc_id, *(r[n] for n in names), r.base_failed, r.kept)) for r in got)


def test_plan_is_native(corpus):
    rules = [(quality_rules.Condition("symbols", True, 100),)]
    plan = quality_rules.apply(corpus, rules)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_learns_planted_thresholds():
    rng = np.random.default_rng(0)
    rows = []
    for _ in range(900):
        row = {name: int(rng.integers(0, 1000)) for name in quality_rules.RATIOS}
        row["bad"] = int(row["symbols"] > 700 or (row["upper"] > 600 and row["words"] <= 300))
        rows.append(row)
    rules = quality_rules.learn(rows)
    caught = [any(quality_rules._covers(rule, r) for rule in rules) for r in rows]
    bad = [r["bad"] for r in rows]
    assert sum(c and b for c, b in zip(caught, bad)) > 0.9 * sum(bad)
    assert sum(c and not b for c, b in zip(caught, bad)) < 0.03 * len(rows)


def test_labels_are_followed_and_order_does_not_matter(spark, sf):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rules = quality_rules.fit(docs, labels)
    assert rules == quality_rules.fit(docs.repartition(5), labels.repartition(3))


def test_rules_without_labels_or_rows(spark, corpus):
    labels = spark.createDataFrame([(None, 1), (100, None)], "doc_id long, quality int")
    assert quality_rules.fit(corpus, labels) == []
    assert quality_rules.apply(corpus.filter("false"), []).collect() == []


def test_additive_model_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    held = crc_fold(F.col("doc_id"), 4) == 2
    model = gam_quality.fit(docs, labels.filter(~held))
    rows = gam_quality.predict(docs.filter(held), model).join(labels, "doc_id").collect()
    assert sum(r.predicted == r.quality for r in rows) >= 0.95 * len(rows)


def test_boosting_finds_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.random((4000, len(gam_quality.FEATURES)))
    y = ((x[:, 2] > 0.5) ^ (x[:, 5] > 0.5)).astype(float)
    model = gam_quality.train(x, y)
    assert (2, 5) in model["pairs"]
    assert ((gam_quality.apply(model, x) > 0.5) == (y > 0.5)).mean() > 0.9


def test_model_on_awkward_rows(spark, corpus):
    labels = spark.createDataFrame([(100 + i, i % 2) for i in range(20)] + [(None, 1), (103, None)], "doc_id long, quality int")
    rows = gam_quality.predict(corpus, gam_quality.fit(corpus, labels)).collect()
    assert len(rows) == corpus.count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    one = gam_quality.fit(corpus, labels.filter("quality = 1"))
    assert {r.predicted for r in gam_quality.predict(corpus, one).collect()} == {1}
    nothing = gam_quality.fit(corpus, labels.filter("false"))
    assert {r.score for r in gam_quality.predict(corpus, nothing).collect()} == {0.5}
    assert gam_quality.predict(corpus.filter("false"), one).collect() == []


@pytest.mark.parametrize("text", ["a a a b", "", None, "One two! Three.\nOne two! Three.\n| x |"])
def test_features_are_finite(text):
    import pyarrow as pa

    x = gam_quality.features(pa.array([text, "other words"], pa.string()))
    assert x.shape == (2, len(gam_quality.FEATURES)) and np.isfinite(x).all()


def test_a_labelled_id_on_many_rows_stays_within_the_bound(spark, monkeypatch):
    docs = spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN 7 ELSE id END AS doc_id", "concat('some words of text ', id) AS text")
    docs = docs.unionByName(docs)  # equal texts of an id count once
    labels = spark.range(100).selectExpr("id AS doc_id", "cast(id % 2 AS int) AS quality")
    seen = {}
    monkeypatch.setattr(gam_quality, "train", lambda x, y: seen.update(gam=len(y)))
    monkeypatch.setattr(quality_rules, "learn", lambda rows: seen.update(rules=len(rows)))
    for most in (50, 2000):
        gam_quality.fit(docs, labels, most=most)
        quality_rules.fit(docs, labels, most=most)
        assert max(seen.values()) <= most
    # all texts of id 7, and the other labelled ids that no third row took
    assert seen == {"gam": 1001 + 65, "rules": 1001 + 65}
