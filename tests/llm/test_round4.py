from __future__ import annotations

import numpy as np

from locusframe.llm import toxicity


def test_every_label_is_learned(spark, monkeypatch):
    """More labelled texts than the 20,000 that were once drawn."""
    n = 22_000
    docs = spark.range(n).selectExpr("id AS doc_id", "if(id % 3 = 0, 'you are vile', concat('kind word', id % 7)) AS text")
    labels = spark.range(n).selectExpr("id AS doc_id", "int(id % 3 = 0) AS toxic")
    kept, store = {}, toxicity.stored
    monkeypatch.setattr(toxicity, "stored", lambda df, label: kept.setdefault(label, store(df, label)))
    found = toxicity.toxicity(docs, labels)
    assert kept["labelled"].count() == n
    assert found.where("predicted <> int(doc_id % 3 = 0)").count() == 0


def test_logistic_sums_of_tasks_equal_one_array(spark):
    draw = np.random.default_rng(5)
    x = np.hstack([np.ones((400, 1)), draw.normal(size=(400, 6))])
    y = (x @ draw.normal(size=7) + draw.logistic(size=400) > 0).astype(int)
    rows = spark.createDataFrame([(a.tolist(), int(b)) for a, b in zip(x, y)], "x array<double>, toxic int").repartition(5)
    beta = toxicity._logistic(rows)
    p = 1 / (1 + np.exp(-x @ beta))
    penalty = np.array([1e-6] + [1.0] * 6) * beta
    assert np.abs(x.T @ (y - p) - penalty).max() < 1e-6
