"""Document quality by a generalised additive model with pairwise interactions.

Each text gives a dozen and a half numbers, counted over its UTF-8 bytes for many texts at once. The model is a sum of
per-feature lookup tables, and of tables over the bins of a few pairs of features. Tables are learned by boosting: shallow
trees over the bins of one feature (or one pair), fitted to the logistic loss in turn, each adding a small step to its table.
Scoring adds up table entries.

Fitting uses a bounded sample of labelled rows outside the held-out quarter.

Cases: null and empty texts have all features zero and get a score like any other; without labels of both kinds every score
is the share of ones among the labels, or 0.5 without any; repeated rows repeat; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import flat_bytes, held_out, labelled_sample, map_batches, table, widened

#: Labelled documents that the model is fitted on, at most (about).
MAX_LABELLED = 20_000
#: From this score on a document is predicted to be of quality.
THRESHOLD = 0.7
#: Bins of a feature, bins of each side of a pair, pairs, rounds for single features and for pairs, step, smallest leaf.
BINS, PAIR_BINS, PAIRS, ROUNDS, PAIR_ROUNDS, STEP, LEAF = 32, 8, 8, 150, 60, 0.15, 8

FEATURES = (
    "log_bytes", "letters", "capitals", "digits", "symbols", "marks", "bangs", "spaces", "newlines",
    "log_words", "word_length", "short_words", "long_words", "symbol_ends", "distinct_words", "repeats_last", "repeats_second", "top_word", "repeated_lines",
)

_LETTER, _UPPER, _DIGIT, _SYMBOL, _MARK, _BANG, _SPACE, _LINE = range(8)


def _classes() -> np.ndarray:
    """For each byte value its eight class flags. Bytes above 127 count as letters."""
    out = np.zeros((256, 8), bool)
    for b in range(256):
        c = chr(b)
        out[b, _LETTER] = b > 127 or c.isalpha()
        out[b, _UPPER] = b < 128 and c.isupper()
        out[b, _DIGIT] = b < 128 and c.isdigit()
        out[b, _SYMBOL] = c in "#$%&*+/<=>@\\^_`{|}~[]"
        out[b, _MARK] = c in ".,;:'\"()-?"
        out[b, _BANG] = c == "!"
        out[b, _SPACE] = c in " \t\r\n\v\f"
        out[b, _LINE] = c == "\n"
    return out


_CLASS = _classes()
_MIX = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15


def _powers(n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    np.multiply.accumulate(np.full(n - 1, _BASE, np.uint64), out=out[1:])
    return out


def _stretch_hashes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A hash of each stretch of bytes. Stretches follow each other in data without overlap and are not empty."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.uint64)
    first = np.cumsum(lengths) - lengths
    inside = np.arange(total) - np.repeat(first, lengths)
    values = _MIX[data[np.repeat(starts, lengths) + inside]] * _powers(int(lengths.max()) + 1)[inside]
    h = np.add.reduceat(values, first)
    h ^= h >> np.uint64(31)
    return h * np.uint64(0xBF58476D1CE4E5B9)


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true."""
    edges = np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def _distinct(doc: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For each document, how many different hashes it has and how often it has its most frequent one."""
    order = np.lexsort((hashes, doc))
    d, h = doc[order], hashes[order]
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (h[1:] != h[:-1])
    at = np.flatnonzero(new)
    most = np.zeros(n)
    np.maximum.at(most, d[at], np.diff(np.append(at, len(d))))
    return np.bincount(d[at], minlength=n), most


def measure(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The features of texts that lie end to end in data, one row each."""
    n = len(offsets) - 1
    sizes = np.diff(offsets)
    flags = _CLASS[data]
    doc_of = np.repeat(np.arange(n), sizes)
    counts = np.stack([np.bincount(doc_of[flags[:, k]], minlength=n) for k in range(8)], 1).astype(float)
    share = counts / np.maximum(sizes, 1)[:, None]
    # A word ends at white space or at the end of its text.
    solid = ~flags[:, _SPACE]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    starts = np.flatnonzero(solid & (cut[:-1] | ~np.concatenate([[False], solid[:-1]])))
    ends = np.flatnonzero(solid & (cut[1:] | ~np.append(solid[1:], False))) + 1
    length, doc = ends - starts, doc_of[starts]
    words = np.bincount(doc, minlength=n).astype(float)
    per = lambda x: np.bincount(doc, x, n) / np.maximum(words, 1)
    h = _stretch_hashes(data, starts, length)
    same1, same2 = np.zeros(len(h)), np.zeros(len(h))
    same1[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    same2[2:] = (h[2:] == h[:-2]) & (doc[2:] == doc[:-2])
    last = flags[ends - 1] if len(ends) else np.zeros((0, 8), bool)
    distinct, most = _distinct(doc, h, n)
    inline = ~flags[:, _LINE]
    line_starts = np.flatnonzero(inline & (cut[:-1] | ~np.concatenate([[False], inline[:-1]])))
    line_ends = np.flatnonzero(inline & (cut[1:] | ~np.append(inline[1:], False))) + 1
    line_doc = doc_of[line_starts]
    lines = np.bincount(line_doc, minlength=n)
    fresh, _ = _distinct(line_doc, _stretch_hashes(data, line_starts, line_ends - line_starts), n)
    return np.stack([
        np.log1p(sizes), share[:, _LETTER], counts[:, _UPPER] / np.maximum(counts[:, _LETTER], 1), share[:, _DIGIT], share[:, _SYMBOL], share[:, _MARK], share[:, _BANG], share[:, _SPACE], share[:, _LINE],
        np.log1p(words), per(length), per(length <= 3), per(length >= 16), per(last[:, _SYMBOL] | last[:, _BANG]), distinct / np.maximum(words, 1), per(same1), per(same2), most / np.maximum(words, 1), 1 - fresh / np.maximum(lines, 1) * (lines > 0) - (lines == 0),
    ], 1)


@dataclass
class Model:
    intercept: float
    #: by feature: upper edges of its bins, and its table
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    #: (feature, feature, edges, edges, table)
    pairs: list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.intercept)
        for k, (e, t) in enumerate(zip(self.edges, self.tables, strict=True)):
            z += t[np.searchsorted(e, x[:, k])]
        for i, j, ei, ej, t in self.pairs:
            z += t[np.searchsorted(ei, x[:, i]), np.searchsorted(ej, x[:, j])]
        return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    """Midpoints between quantiles, so that a bin's edge is never a value that occurs."""
    values, counts = np.unique(x, return_counts=True)
    if len(values) < 2:
        return np.zeros(0)
    mids = (values[1:] + values[:-1]) / 2
    rank = np.cumsum(counts)[:-1] / len(x)
    return np.unique(mids[np.unique(np.searchsorted(rank, np.arange(1, bins) / bins).clip(0, len(mids) - 1))])


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + 1.0)


def _tree(g: np.ndarray, h: np.ndarray, n: np.ndarray, splits: int = 3) -> np.ndarray:
    """Leaf values along the bins of one feature: up to `splits` greedy cuts into ranges."""
    cg, ch, cn = (np.concatenate([[0], np.cumsum(v)]) for v in (g, h, n))
    cuts = [0, len(g)]
    for _ in range(splits):
        best, at = 1e-9, None
        for a, b in zip(cuts, cuts[1:]):
            if b - a < 2:
                continue
            m = np.arange(a + 1, b)
            gain = _gain(cg[m] - cg[a], ch[m] - ch[a]) + _gain(cg[b] - cg[m], ch[b] - ch[m]) - _gain(cg[b] - cg[a], ch[b] - ch[a])
            gain[(cn[m] - cn[a] < LEAF) | (cn[b] - cn[m] < LEAF)] = 0
            k = int(gain.argmax())
            if gain[k] > best:
                best, at = gain[k], int(m[k])
        if at is None:
            break
        cuts = sorted([*cuts, at])
    out = np.zeros(len(g))
    for a, b in zip(cuts, cuts[1:]):
        out[a:b] = (cg[b] - cg[a]) / (ch[b] - ch[a] + 1.0)
    return out


def _grid_tree(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, float]:
    """Leaf values over the bins of a pair, a cut along one side and then one in each half along the other; and the gain."""
    best, out = 1e-9, np.zeros_like(g)
    whole = _gain(g.sum(), h.sum())
    for flip in (False, True):
        a, b, c = (v.T if flip else v for v in (g, h, n))
        for cut in range(1, a.shape[0]):
            value, total = np.zeros(a.shape), -whole
            for part in (slice(0, cut), slice(cut, None)):
                pg, ph, pn = a[part].sum(0), b[part].sum(0), c[part].sum(0)
                cg, ch, cn = np.cumsum(pg)[:-1], np.cumsum(ph)[:-1], np.cumsum(pn)[:-1]
                gain = _gain(cg, ch) + _gain(pg.sum() - cg, ph.sum() - ch)
                gain[(cn < LEAF) | (pn.sum() - cn < LEAF)] = 0
                k = int(gain.argmax()) + 1 if len(gain) and gain.max() > _gain(pg.sum(), ph.sum()) else 0
                for side in (slice(0, k), slice(k, None)):
                    if len(pg[side]):
                        total += _gain(pg[side].sum(), ph[side].sum())
                        value[part, side] = pg[side].sum() / (ph[side].sum() + 1.0)
            if total > best:
                best, out = total, value.T if flip else value
    return out, best


def fit(x: np.ndarray, y: np.ndarray, w: np.ndarray | None = None) -> Model:
    """w: what each row counts for; scores are right for rows in those shares."""
    width = len(FEATURES)
    w = np.ones(len(y)) if w is None or not len(w) else w / w.mean()
    if not len(y) or y.min() == y.max():
        share = np.clip(y.mean() if len(y) else 0.5, 1e-9, 1 - 1e-9)
        return Model(float(np.log(share / (1 - share))), [np.zeros(0)] * width, [np.zeros(1)] * width, [])
    edges = [_edges(x[:, k], BINS) for k in range(width)]
    bins = [np.searchsorted(e, x[:, k]) for k, e in enumerate(edges)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    mean = np.average(y, weights=w)
    intercept = float(np.log(mean / (1 - mean)))
    z = np.full(len(y), intercept)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-z))
        return w * (y - p), w * p * (1 - p)

    for _ in range(ROUNDS):
        for k in range(width):
            g, h = slopes()
            m = len(tables[k])
            step = STEP * np.clip(_tree(np.bincount(bins[k], g, m), np.bincount(bins[k], h, m), np.bincount(bins[k], minlength=m)), -4, 4)
            tables[k] += step
            z += step[bins[k]]
    coarse = [_edges(x[:, k], PAIR_BINS) for k in range(width)]
    few = [np.searchsorted(e, x[:, k]) for k, e in enumerate(coarse)]

    def grid(i: int, j: int) -> tuple[np.ndarray, float]:
        g, h = slopes()
        shape = (len(coarse[i]) + 1, len(coarse[j]) + 1)
        cell = few[i] * shape[1] + few[j]
        return _grid_tree(*(np.bincount(cell, w, shape[0] * shape[1]).reshape(shape) for w in (g, h, np.ones(len(y)))))

    ranked = sorted(((grid(i, j)[1], i, j) for i in range(width) for j in range(i)), reverse=True)[:PAIRS]
    pairs = [(i, j, coarse[i], coarse[j], np.zeros((len(coarse[i]) + 1, len(coarse[j]) + 1))) for _, i, j in ranked]
    for _ in range(PAIR_ROUNDS):
        for i, j, _, _, t in pairs:
            step = STEP * np.clip(grid(i, j)[0], -4, 4)
            t += step
            z += step[few[i], few[j]]
    return Model(intercept, edges, tables, pairs)


def features(docs: DataFrame) -> DataFrame:
    """docs with an array column `quality_features`, in the order of FEATURES."""
    kept = docs.drop("quality_features")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 250):
                part = batch.slice(k, 250)
                x = measure(*flat_bytes(part))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(list(x), pa.list_(pa.float64()))], [*part.schema.names, "quality_features"])

    return map_batches(kept, run, widened(kept, "quality_features array<double>"))


def fit_on(docs: DataFrame, labels: DataFrame, at_most: int = MAX_LABELLED) -> Model:
    """Learns from about at_most of the labelled rows that are not held out; only their features reach the driver."""
    rows = features(labelled_sample(docs, labels, "quality", at_most)).select("doc_id", "y", "w", "quality_features").collect()
    rows.sort(key=lambda r: (r[0], r[3]))
    return fit(np.array([r[3] for r in rows]).reshape(-1, len(FEATURES)), np.array([r[1] for r in rows], float), np.array([r[2] for r in rows], float))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """docs with `quality_score` (0 to 1)."""
    kept = docs.drop("quality_score")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 250):
                part = batch.slice(k, 250)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(model.score(measure(*flat_bytes(part))))], [*part.schema.names, "quality_score"])

    return map_batches(kept, run, widened(kept, "quality_score double"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit_on(docs, table(spark, sf_dir, "labels"))
    return score(docs.select("doc_id", "text"), model).select(
        "doc_id",
        held_out(4, 2).alias("held_out"),
        F.col("quality_score").alias("score"),
        (F.col("quality_score") >= THRESHOLD).cast("int").alias("predicted"),
    )


QUERIES = {"op2_quality": op2_quality}
ORACLES: dict[str, str] = {}
