"""Rows that the fit of op2 takes."""

from __future__ import annotations

from pyspark.sql import functions as F

from foldmill.llm import pii, trees


def test_all_labelled_candidates_are_in_the_fit(spark, monkeypatch):
    texts = F.concat(F.lit("token=AKIA"), F.sha2(F.col("id").cast("string"), 256), F.lit(" end"))
    rows = pii.candidates(pii.cuts(spark.range(400).select(F.col("id").alias("doc_id"), texts.alias("text"))))
    given = []
    monkeypatch.setattr(trees, "fit", lambda found, **more: given.extend(found.collect()) or trees.Boosted())
    pii.fitted(rows, 50)
    secrets = [r for r in given if r["features"][0] == pii.KINDS.index("secret")]
    assert 150 < len(secrets) < 250  # a half; the other half sets thresholds
    assert abs(sum(r["weight"] for r in secrets) - len(secrets) * 50 / 400) < 1e-9
    assert all(r["weight"] == 1.0 for r in given if r["features"][0] != pii.KINDS.index("secret"))
