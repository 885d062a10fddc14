"""The two classifiers' queries: what they return, what they may not learn from, how well they do on held-out rows of both tables; and
the additive model's scores beside a plain look-up of every bin."""

from __future__ import annotations

import math
import os
import zlib
from bisect import bisect_left

import numpy as np
import pytest
from pyspark.sql import functions as F

from loadweave.llm import quality, toxicity

TABLES = "/root/testdata"


def auc(scores, labels):
    """How often a row with label 1 has the higher score, ties by half."""
    up, down = np.array(scores)[np.array(labels) == 1], np.array(scores)[np.array(labels) == 0]
    return ((up[:, None] > down).mean() + (up[:, None] >= down).mean()) / 2


def test_scores_are_sums_of_bins():
    rng = np.random.default_rng(2)
    x = rng.integers(0, 6, (800, len(quality.FEATURES))).astype(float)
    y = ((x[:, 0] > 2) ^ (x[:, 3] > 3) | (rng.random(800) < 0.05)).astype(float)
    model = quality.fit(x, y)
    assert model.pairs
    for row, got in zip(x[:200], model.score(x[:200]), strict=True):
        z = model.intercept + sum(t[bisect_left(e.tolist(), v)] for e, t, v in zip(model.edges, model.tables, row, strict=True))
        z += sum(t[bisect_left(ei.tolist(), row[i]), bisect_left(ej.tolist(), row[j])] for i, j, ei, ej, t in model.pairs)
        assert got == pytest.approx(1 / (1 + math.exp(-z)), rel=1e-9)


@pytest.mark.parametrize(("query", "label", "threshold"), [(quality.op2_quality, "quality", quality.THRESHOLD), (toxicity.op9_toxicity, "toxic", toxicity.THRESHOLD)])
def test_held_out_labels_play_no_part(spark, tmp_path, query, label, threshold):
    """Held-out labels turned round, and other columns of documents changed, give the same rows."""
    sf_dir = f"{TABLES}/sf0.01"
    rows = {r["doc_id"]: r.asDict() for r in query(spark, sf_dir).collect()}
    ids = [r[0] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id").collect()]
    assert sorted(rows) == sorted(ids)
    for doc, r in rows.items():
        assert r["held_out"] == (zlib.crc32(str(doc).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= threshold)
    out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    labels.withColumn(label, F.when(out, 1 - F.col(label)).otherwise(F.col(label))).write.parquet(str(tmp_path / "labels.parquet"))
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    documents.withColumns({"lang": F.lit("xx"), "source": F.reverse("source")}).write.parquet(str(tmp_path / "documents.parquet"))
    for r in query(spark, str(tmp_path)).collect():
        assert r.asDict() == rows[r["doc_id"]]


@pytest.mark.parametrize(("query", "label", "sf", "least"), [
    (quality.op2_quality, "quality", "sf0.01", 0.95), (quality.op2_quality, "quality", "sf0.1", 0.95),
    (toxicity.op9_toxicity, "toxic", "sf0.01", 0.75), (toxicity.op9_toxicity, "toxic", "sf0.1", 0.95),
])
def test_held_out_order(spark, query, label, sf, least):
    labels = spark.read.parquet(os.path.join(TABLES, sf, "labels.parquet")).where(F.col(label).isNotNull())
    rows = query(spark, os.path.join(TABLES, sf)).where("held_out").join(labels, "doc_id").select("score", label).collect()
    assert auc([r[0] for r in rows], [r[1] for r in rows]) >= least
