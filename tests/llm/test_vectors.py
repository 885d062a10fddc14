"""Codebooks and whitening beside brute force in Python's integers, and exact duplicates beside SQL; edges of each."""

from __future__ import annotations

import hashlib
import math
from fractions import Fraction

import duckdb
import numpy as np
import pytest

from loadweave.llm import codebooks, common, exactdedup, vectors, whitening

ROWS = "vec_id long, embedding array<float>, label int"


def table_of(spark, rows, schema=ROWS):
    return spark.createDataFrame(rows, schema)


def random_rows(n, width, seed=1, scale=0.3):
    rng = np.random.default_rng(seed)
    return [(int(k), [float(v) for v in rng.normal(0, scale, width).astype(np.float32)], int(k % 3) if k % 5 else None) for k in rng.permutation(n)]


EDGES = [(900, None, 1), (901, [0.5, None] + [0.0] * 14, 1), (902, [float("nan")] * 16, 1), (903, [float("inf")] + [0.0] * 15, None), (904, [0.25] * 16, None), (904, [0.25] * 16, None), (None, [0.5] * 16, 2)]


def brute_codes(rows, parts=8, entries=16, rounds=6, scale=4096):
    good = [(i, [math.floor(scale * x) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    w = len(good[0][1]) // parts
    cut = lambda x, p: x[p * w : (p + 1) * w]
    first = sorted(good, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[cut(x, p) for _, x, _ in first] for p in range(parts)]
    near = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), e) for e, c in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            own = [[] for _ in books[p]]
            for _, x, _ in good:
                own[near(cut(x, p), books[p])[1]].append(cut(x, p))
            books[p] = [[sum(v) // len(of) for v in zip(*of, strict=True)] if of else c for of, c in zip(own, books[p], strict=True)]
    out, by_label = [], {}
    for i, x, label in good:
        found = [near(cut(x, p), books[p]) for p in range(parts)]
        out.append((i, "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found), label))
        by_label[label] = by_label.get(label, 0) + out[-1][2]
    sha = hashlib.sha256(",".join(str(v) for book in books for c in book for v in c).encode()).hexdigest()
    return sorted(((i, c, e, by_label[label], sha) for i, c, e, label in out), key=repr)


def coded_rows(df):
    model = codebooks.fit(df)
    out = codebooks.with_label_error(codebooks.encode(df, model))
    return sorted(((r["vec_id"], r["code"], int(r["error"]), int(r["label_error"]), model.sha256()) for r in out.collect()), key=repr)


@pytest.mark.parametrize("rows", [random_rows(300, 16) + EDGES, random_rows(9, 16), random_rows(40, 24, scale=3e6), [(k, [1.0, 2.0] * 8, 0) for k in range(30)]])
def test_codes_like_brute_force(spark, rows):
    assert coded_rows(table_of(spark, rows).repartition(5)) == brute_codes(rows)


def test_codes_of_uneven_and_empty_vectors(spark):
    """Shorter vectors count as if zeros followed, up to a multiple of the parts."""
    rows = [(1, [], 0), (2, [0.5], 0), (3, [0.25] * 10, 1)]
    assert coded_rows(table_of(spark, rows)) == brute_codes([(i, v + [0.0] * (16 - len(v)), label) for i, v, label in rows])
    assert coded_rows(table_of(spark, [(1, [], 0)])) == [(1, "00" * 8, 0, 0, hashlib.sha256(b"").hexdigest())]
    assert coded_rows(table_of(spark, [])) == []


def test_too_large_components_take_no_part(spark):
    df = table_of(spark, [(1, [1e30] * 8, 0), (2, [0.5] * 8, 0)])
    assert [r[0] for r in coded_rows(df)] == [2]
    assert vectors.taking_part(df, "embedding", 1024).count() == 1


def test_many_labels_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(codebooks, "BROADCAST_LABELS", 1)
    rows = random_rows(200, 16)
    assert coded_rows(table_of(spark, rows)) == brute_codes(rows)


def test_codes_decode_near_the_vectors(spark):
    df = table_of(spark, random_rows(400, 16))
    model = codebooks.fit(df)
    coded = codebooks.encode(df, model)
    back = {r["vec_id"]: np.array(r["vector"]) for r in codebooks.decode(coded, model).collect()}
    errors = {r["vec_id"]: int(r["error"]) for r in coded.collect()}
    for i, v, _ in random_rows(400, 16):
        gap = np.floor(np.array(v) * 4096) - back[i] * 4096
        assert round(float((gap**2).sum())) == errors[i]


def test_codebook_query_like_its_sql(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf_dir}/embeddings.parquet'")
    found = con.execute(codebooks.ORACLE)
    names = [d[0] for d in found.description]
    df = codebooks.op11_codebooks(spark, sf_dir)
    assert sorted(names) == sorted(df.columns)
    assert sorted(map(tuple, df.select(*names).collect())) == sorted(found.fetchall())


# Whitening


def test_limbs_and_products_are_exact():
    rng = np.random.default_rng(3)
    for most in (5, 2**20, 2**45, 2**61):
        d = rng.integers(-most, most, (4096, 3), endpoint=True)
        cut = whitening.limbs(d)
        assert (sum(c.astype(np.int64).astype(object) << (20 * k) for k, c in enumerate(cut)) == d.astype(object)).all()
        assert all(0 <= c.min() and c.max() < 2**20 for c in cut[:-1]) and abs(cut[-1]).max() < 2**20
        assert (whitening.exact_products(d) == d.astype(object).T @ d.astype(object)).all()
    d = np.array([[2**90 + 1, -3], [-(2**70), 5]], object)
    assert (whitening.exact_products(d) == d.T @ d).all()


def brute_whitening(rows, scale=1024, add=100_000):
    """Covariance in fractions, then numpy; ids, deviations, eigenvalues, components, whitened."""
    good = [(i, [math.floor(scale * c) + add for c in v]) for i, v, _ in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    n, width = len(good), len(good[0][1])
    mean = [Fraction(sum(x[k] for _, x in good), n) for k in range(width)]
    centred = [[x[k] - mean[k] for k in range(width)] for _, x in good]
    covariance = np.array([[float(sum(c[i] * c[j] for c in centred) / n) for j in range(width)] for i in range(width)])
    values, axes = np.linalg.eigh(covariance)
    z = np.array([[float(v) for v in c] for c in centred]) @ axes[:, ::-1] / np.sqrt(np.abs(values[::-1]))
    return n, {i: int(sum((n * v) ** 2 for v in c)) for (i, _), c in zip(good, centred, strict=True)}, values[::-1], z, [i for i, _ in good]


@pytest.mark.parametrize("rows", [random_rows(120, 10) + [(i, v[:10] if v else v, label) for i, v, label in EDGES], random_rows(60, 5), random_rows(40, 9, scale=1e6)])
def test_whitening_like_fractions(spark, rows):
    df = table_of(spark, rows).repartition(4)
    model = whitening.fit(df)
    n, deviations, values, z, ids = brute_whitening(rows)
    c = min(8, len(values))
    assert model.n == n and len(model.eigenvalues) == c
    assert np.allclose(model.eigenvalues, values[:c], rtol=1e-10) and math.isclose(model.trace, values.sum(), rel_tol=1e-12)
    got = {r["vec_id"]: r for r in whitening.transform(df, model).collect()}
    for k, i in enumerate(ids):
        assert int(got[i]["deviation"]) == deviations[i]
        assert np.allclose(np.abs(got[i]["whitened"]), np.abs(z[k][:c]), atol=1e-7)
    assert whitening.identity_error(df, model) < 1e-8


def test_whitening_of_little(spark):
    for rows in ([], [(1, None, 0)], [(1, [], 0)]):
        assert whitening.fit(table_of(spark, rows)).n == 0
    same = table_of(spark, [(k, [0.5, 1.0, -2.0], 0) for k in range(5)])
    model = whitening.fit(same)
    assert model.n == 5 and len(model.eigenvalues) == 0 and whitening.identity_error(same, model) == 0.0
    line = table_of(spark, [(k, [k / 4, k / 2, 1.0], 0) for k in range(5)])
    model = whitening.fit(line)
    assert len(model.eigenvalues) == 1 and whitening.identity_error(line, model) < 1e-9
    short = table_of(spark, [(1, [0.5], 0), (2, [0.5, 1.0], 0), (3, [1.5, 0.0], 0)])
    full = table_of(spark, [(1, [0.5, 0.0], 0), (2, [0.5, 1.0], 0), (3, [1.5, 0.0], 0)])
    assert np.array_equal(whitening.fit(short).components, whitening.fit(full).components)


def test_whitening_query(spark, sf_dir, tmp_path):
    df = whitening.op13_whitening(spark, sf_dir)
    rows = df.collect()
    assert len(rows) == 8 * spark.read.parquet(f"{sf_dir}/embeddings.parquet").count()
    assert {r["component"] for r in rows} == set(range(1, 9)) and all(0 < r["identity_error"] < 1e-8 and 0 < r["explained"] < 1 for r in rows)
    table_of(spark, []).write.parquet(f"{tmp_path}/embeddings.parquet")
    assert whitening.op13_whitening(spark, str(tmp_path)).schema == df.schema and whitening.op13_whitening(spark, str(tmp_path)).count() == 0
    assert codebooks.op11_codebooks(spark, str(tmp_path)).count() == 0


# Exact duplicates

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CASES = [(1, None), (2, ""), (3, "a"), (3, "a"), (None, "a"), (4, "A"), (None, None), (None, "only"), (None, "only"), (5, "é" * 10_000), (6, "é" * 10_000), (7, "a "), (8, "one")]


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", None) for i, t in rows], DOCS)


def brute_classes(rows):
    groups: dict[str, list] = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    out = []
    for t, ids in groups.items():
        best = max((i for i in ids if i is not None), default=None)
        left = [best]
        for i in ids:
            out.append((i, best, len(ids), i in left, hashlib.sha256(t.encode()).hexdigest()))
            if i in left:
                left.remove(i)
    return sorted(out, key=repr)


def classes_of(df):
    return sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["kept"], r["digest"].hex()) for r in exactdedup.classes(df).collect()), key=repr)


@pytest.mark.parametrize("at_most", [4096, 8])
def test_classes_like_brute_force(spark, monkeypatch, at_most):
    """With all digests tracked, every group of copies is a heavy one; with few, only the largest is."""
    monkeypatch.setattr(exactdedup, "tracked", lambda s: at_most)
    rows = CASES + [(100 + k, "common") for k in range(700)] + [(k, f"text {k % 250}") for k in range(1000, 1600)]
    assert classes_of(documents(spark, rows).repartition(6)) == brute_classes(rows)


def test_heavy_groups_are_found_whatever_the_order(spark, monkeypatch):
    for at_most in (8, 64):
        for seed in range(3):
            rng = np.random.default_rng(seed)
            names = [f"d{int(v)}" for v in rng.zipf(1.3, 5000) % 4000]
            df = spark.createDataFrame([(n,) for n in names], "d string").repartition(7).selectExpr("xxhash64(d) AS h", "d")
            found = {r[0] for r in exactdedup.frequent(df, "h", at_most).collect()}
            counts = {r["h"]: r["count"] for r in df.groupBy("h").count().collect()}
            size = 2 ** math.ceil(math.log2(at_most / 0.75))
            assert {h for h, n in counts.items() if n > 7 / size * len(names)} <= found and len(found) <= at_most


def test_deduplicated_keeps_columns_and_one_row_each(spark):
    """Columns that clash with names used inside, a map column, repeated rows, null ids."""
    df = documents(spark, CASES).selectExpr("*", "doc_id AS digest", "text AS lost_digest", "1 AS lost_doc", "2 AS kept", "map('k', doc_id) AS m")
    out = exactdedup.deduplicated(df)
    assert out.schema == df.schema
    got = sorted((r["text"] or "", r["doc_id"]) for r in out.collect())
    assert [t for t, _ in got] == sorted({t or "" for _, t in CASES})
    assert {t: i for t, i in got} == {t: i for i, i2, n, k, h in brute_classes(CASES) if k for t in {x or "" for _, x in CASES} if hashlib.sha256(t.encode()).hexdigest() == h}
    assert exactdedup.deduplicated(df.limit(0)).count() == 0


def test_exact_query_like_its_sql(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    found = con.execute(exactdedup.ORACLE)
    names = [d[0] for d in found.description]
    df = exactdedup.op12_exact_dedup(spark, sf_dir)
    assert "Python" not in df._jdf.queryExecution().toString() and "Arrow" not in df._jdf.queryExecution().toString()
    assert sorted(names) == sorted(df.columns)
    assert sorted(map(tuple, df.select(*names).collect())) == sorted(found.fetchall())


def test_fresh_names_do_not_clash(spark):
    df = spark.createDataFrame([(1, 2)], "A int, _a int")
    assert common.fresh(df, "a", "b", "b") == ["__a", "b", "_b"]
