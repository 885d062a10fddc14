"""Prefix doubling over all positions against brute force and against the anchors that the query of operator 3 uses."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from loadweave.llm import doubling, suffixdedup

SCHEMA = "doc_id long, text string, rank string, at string"


def brute(rows):
    texts = [(suffixdedup.FIRST if i is None else i, (t or "").encode()) for i, t in rows]
    first: dict[bytes, tuple] = {}
    for i, b in texts:
        for s in range(len(b) - 99):
            first[b[s : s + 100]] = min(first.get(b[s : s + 100], (i, s)), (i, s))
    out = []
    for (i, _), (d, b) in zip(rows, texts, strict=True):
        gone = bytearray(len(b))
        for s in range(len(b) - 99):
            if first[b[s : s + 100]] != (d, s):
                gone[s : s + 100] = b"\1" * 100
        if any(gone):
            out.append((i, sum(gone), sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1]))))
    return sorted(out, key=repr)


def made(spark, rows):
    return spark.createDataFrame([(i, t, "r", "a") for i, t in rows], SCHEMA)


def sample():
    rng = random.Random(5)
    parts = ["".join(rng.choice("abcdé ") for _ in range(rng.randint(1, 60))) for _ in range(40)]
    rows = [(k, "".join(rng.choice(parts) for _ in range(rng.randint(0, 30)))) for k in range(30)]
    rows += [(100, "a" * 400), (101, "ab" * 150), (102, rows[3][1]), (102, rows[3][1]), (None, rows[5][1])]
    return [*rows, (103, "x" * 99), (104, rows[2][1] * 2), (105, None), (106, ""), (107, "\x00" * 120)]


def test_doubling_by_brute_force(spark):
    rows = sample()
    got = doubling.repeats(made(spark, rows).repartition(4))
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)


def test_partners_across_blocks(spark, monkeypatch):
    monkeypatch.setattr(doubling, "BLOCK", 128)
    rows = sample()
    got = doubling.repeats(made(spark, rows).repartition(4))
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)


def test_doubling_agrees_with_anchors(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    spans = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["start"])
    anchors = suffixdedup.removed(docs).select("doc_id", spans.alias("n"), F.size("spans").cast("long").alias("k")).where("n > 0")
    got = {tuple(r) for r in doubling.repeats(docs).collect()}
    assert got == {tuple(r) for r in anchors.collect()} and got


def test_no_rows(spark):
    assert doubling.repeats(made(spark, [])).count() == 0
