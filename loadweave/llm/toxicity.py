"""Toxic spans by a linear-chain conditional random field.

Fitting, on a bounded sample of labelled documents:

1. A token is a run of letters, in lower case. Its features are the token itself and its prefixes of 4, 5 and 6 letters.
2. A feature is taken up if the documents that have it are toxic far more often than the rest: a likelihood-ratio test
   whose threshold rises with the number of features tried. Tokens of toxic documents with such a feature are the labelled
   toxic tokens, all others are not toxic.
3. The field has two tags, a weight for each feature taken up, a bias, and four transition weights. It is fitted by gradient
   steps; forward-backward gives the expectations.

Scoring: forward-backward marginals of each whole text. A document's score is a logistic function, fitted on the same
sample, of the marginals' noisy-or and their sum. Spans are runs of tokens with a marginal of 0.5 or more.

Cases: null and empty texts, and texts without letters, get the score of no evidence and no spans; without labels of both
kinds every score is the share of toxic labels, or 0; repeated rows repeat; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import held_out, labelled_sample, map_batches, table, texts_of, widened

#: Labelled documents that the model is fitted on, at most (about).
MAX_LABELLED = 2000
#: Tokens of whole documents that the fit goes through at once, about.
TOKENS_AT_ONCE = 200_000
#: Tokens whose weights a worker keeps.
CACHE_ENTRIES = 400_000
#: Marginals below this count as none, so that the length of a clean text is no evidence.
FLOOR = 0.05
#: From this score on a document counts as toxic.
THRESHOLD = 0.3
_WORD = re.compile(r"[^\W\d_]+")
_BLOCK = 64


def tokens(text: str) -> list[str]:
    low = text.lower()
    # Some capitals are longer in lower case; words are found in the text as it is then, so that offsets stay right.
    return _WORD.findall(low) if len(low) == len(text) else [w.lower() for w in _WORD.findall(text)]


def features(token: str) -> tuple[str, ...]:
    return (token, *(token[:n] + "*" for n in (4, 5, 6) if len(token) > n))


@dataclass
class Model:
    weights: dict[str, float] = field(default_factory=dict)
    bias: float = -4.0
    #: exp of the transition weights, from tag to tag
    trans: np.ndarray = field(default_factory=lambda: np.ones((2, 2)))
    #: intercept, weight of the noisy-or's logit, weight of log(1 + expected toxic tokens)
    head: tuple[float, float, float] = (-20.0, 0.0, 0.0)


def _prefix_ratios(m: list[np.ndarray]) -> np.ndarray:
    """v1 / v0 of the row vectors (1, 1) M_0, (1, 1) M_0 M_1, ...; m: the matrices' entries 00, 01, 10, 11.

    Products run along blocks of 64 positions, all blocks at once; a short loop then carries the vector over the blocks."""
    n = len(m[0])
    rows = -(-n // _BLOCK)
    a, b, c, d = (np.concatenate([x, np.full(rows * _BLOCK - n, fill)]).reshape(rows, _BLOCK).T.copy() for x, fill in zip(m, (1.0, 0.0, 0.0, 1.0), strict=True))
    for k in range(1, _BLOCK):
        pa_, pb, pc, pd = a[k - 1], b[k - 1], c[k - 1], d[k - 1]
        na, nb, nc, nd = pa_ * a[k] + pb * c[k], pa_ * b[k] + pb * d[k], pc * a[k] + pd * c[k], pc * b[k] + pd * d[k]
        scale = 1 / np.maximum(np.maximum(na, nb), np.maximum(nc, nd))
        a[k], b[k], c[k], d[k] = na * scale, nb * scale, nc * scale, nd * scale
    v0, v1 = np.empty(rows), np.empty(rows)
    x, y = 1.0, 1.0
    for r, (ea, eb, ec, ed) in enumerate(zip(a[-1].tolist(), b[-1].tolist(), c[-1].tolist(), d[-1].tolist(), strict=True)):
        v0[r], v1[r] = x, y
        x, y = x * ea + y * ec, x * eb + y * ed
        s = x + y
        x, y = x / s, y / s
    return ((v0 * b + v1 * d) / np.maximum(v0 * a + v1 * c, 1e-300)).T.reshape(-1)[:n]


def forward_backward(emission: np.ndarray, starts: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Marginals of the toxic tag, and the ratios of forward and backward values, of many sequences end to end.

    emission: log weight of the toxic tag at each token; starts: whether a sequence starts there."""
    if not len(emission):
        return (np.zeros(0),) * 3
    pot = np.exp(np.clip(emission, -30, 30))
    first = starts.astype(bool)
    forward = _prefix_ratios([np.where(first, 1.0, trans[0, 0]), np.where(first, 1.0, trans[0, 1]) * pot, np.where(first, 1.0, trans[1, 0]), np.where(first, 1.0, trans[1, 1]) * pot])
    last = np.append(first[1:], True)
    following = np.append(pot[1:], 1.0)
    steps = [np.where(last, 1.0, trans[0, 0]), np.where(last, 1.0, trans[1, 0]), np.where(last, 1.0, trans[0, 1] * following), np.where(last, 1.0, trans[1, 1] * following)]
    backward = _prefix_ratios([x[::-1] for x in steps])[::-1]
    odds = np.minimum(forward * backward, 1e300)
    return odds / (1 + odds), forward, backward


def _evidence(p: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """For each of n sequences, the logit of the marginals' noisy-or and log(1 + their sum); at: each token's sequence."""
    p = np.where(p >= FLOOR, p, 0.0)
    none = np.bincount(at, np.log1p(-np.minimum(p, 1 - 1e-9)), n)
    some = -np.expm1(none)
    logit = np.log(np.maximum(some, 1e-9)) - np.maximum(none, -20)
    return np.stack([np.ones(n), np.clip(logit, -20, 20), np.log1p(np.bincount(at, p, n))], 1)


def significant_features(docs: list[list[str]], y: np.ndarray) -> set[str]:
    """Features that toxic documents have far more often.

    A feature counts once for each toxic document, but no more often than it stands between different neighbours, so that
    the words of a document with many copies do not pass for toxic ones."""
    pos: Counter[str] = Counter()
    between: dict[str, set[int]] = {}
    for words, toxic in zip(docs, y.tolist(), strict=True):
        if toxic:
            pos.update({f for w in set(words) for f in features(w)})
            for before, w, after in zip(["", *words], words, [*words[1:], ""], strict=False):
                for f in features(w):
                    between.setdefault(f, set()).add(hash((before, after)))
    pos = Counter({f: k for f, n in pos.items() if (k := min(n, len(between[f]))) >= 3})
    own: dict[str, tuple[str, ...]] = {}
    neg: Counter[str] = Counter()
    for words, toxic in zip(docs, y.tolist(), strict=True):
        if not toxic:
            for w in (distinct := set(words)):
                if w not in own:
                    own[w] = tuple(f for f in features(w) if f in pos)
            neg.update({f for w in distinct for f in own[w]})
    n1, n0 = int(y.sum()), int(len(y) - y.sum())
    least, found, share = 2 * math.log(max(2, len(pos))) + 6, [], n1 / (n1 + n0)
    for f, a in pos.items():
        b = neg[f]
        if a * n0 > 4 * b * n1:
            g = 2 * (a * math.log(a / ((a + b) * share)) + (b * math.log(b / ((a + b) * (1 - share))) if b else 0))
            if g >= least:
                found.append(f)
    return set(found)


def _in_parts(docs: list[list[str]], y: np.ndarray, empty: bool = False) -> Iterator[list[tuple[list[str], int]]]:
    """(words, label) in lists of about TOKENS_AT_ONCE words; documents without words only if asked for."""
    part, size = [], 0
    for words, label in zip(docs, y.tolist(), strict=True):
        if words or empty:
            part.append((words, label))
            size += len(words)
        if size >= TOKENS_AT_ONCE:
            yield part
            part, size = [], 0
    if part:
        yield part


def fit(rows: Iterable[tuple], steps: int = 60, rate: float = 0.5, ridge: float = 1e-3) -> Model:
    """rows: (text, 0 or 1), or with what the row counts for as a third value."""
    docs, y, stands = [], [], []
    one: dict[str, str] = {}  # equal tokens are one object
    for text, label, *weight in rows:
        docs.append([one.setdefault(t, t) for t in tokens(text or "")])
        y.append(int(label))
        stands.append(weight[0] if weight else 1.0)
    y, stands = np.array(y, np.int64), np.array(stands, float)
    share = float(np.average(y, weights=stands)) if len(y) else 0.0
    if share in (0.0, 1.0):
        return Model(head=(math.log(max(share, 1e-9) / max(1 - share, 1e-9)), 0.0, 0.0))
    chosen = sorted(significant_features(docs, y))
    number = {f: k for k, f in enumerate(chosen)}
    own: dict[str, list[int]] = {}
    parts = []
    for some in _in_parts(docs, y):
        pairs: list[tuple[int, int]] = []
        tags, starts = [], []
        for words, toxic in some:
            for k, w in enumerate(words):
                if w not in own:
                    own[w] = [number[f] for f in features(w) if f in number]
                pairs += [(len(tags), f) for f in own[w]]
                tags.append(bool(own[w]) and toxic == 1)
                starts.append(k == 0)
        at = np.array(pairs, np.int64).reshape(-1, 2)
        parts.append((np.array(tags, bool), np.array(starts, bool), at[:, 0], at[:, 1]))
    if not parts:
        return Model(head=(math.log(share / (1 - share)), 0.0, 0.0))
    # The ridge weighs against the tokens that have chosen features, and not against how long texts are.
    n = 20 * max(1, sum(len(np.unique(at)) for _, _, at, _ in parts))
    seen = sum(np.array([np.sum(~s[1:] & (t[:-1] == i) & (t[1:] == j)) for i in (0, 1) for j in (0, 1)]) for t, s, _, _ in parts)
    ridges = np.append(np.full(len(chosen), 1 / max(1, len(chosen))), [0, 1e-1, 1e-1, 1e-1, 1e-1])
    theta = np.concatenate([np.zeros(len(chosen)), [-2.0, 0, 0, 0, 0]])
    m1, m2 = np.zeros_like(theta), np.zeros_like(theta)
    for k in range(1, steps + 1):
        trans = np.exp(theta[-4:]).reshape(2, 2)
        gain = np.zeros_like(theta)
        both = np.zeros(4)
        for t, s, rows_, cols in parts:
            emission = np.bincount(rows_, theta[cols], len(t)) + theta[-5]
            p, fw, bw = forward_backward(emission, s, trans)
            pot = np.exp(np.clip(emission[1:], -30, 30))
            f, b = fw[:-1], bw[1:]
            steps_ = np.stack([trans[0, 0] + 0 * f, trans[0, 1] * pot * b, trans[1, 0] * f, trans[1, 1] * f * pot * b])
            both += (steps_ / steps_.sum(0))[:, ~s[1:]].sum(1)
            gain[: len(chosen)] += np.bincount(cols, (t - p)[rows_], len(chosen))
            gain[-5] += np.sum(t - p)
        gain[-4:] = seen - both
        gain = gain / n - ridge * theta * ridges
        m1, m2 = 0.9 * m1 + 0.1 * gain, 0.99 * m2 + 0.01 * gain**2
        theta += rate * (m1 / (1 - 0.9**k)) / (np.sqrt(m2 / (1 - 0.99**k)) + 1e-9) / (1 + k / 40)
    model = Model(dict(zip(chosen, theta[: len(chosen)].tolist(), strict=True)), float(theta[-5]), np.exp(theta[-4:]).reshape(2, 2))
    tagger = _Tagger(model)
    x = np.concatenate([tagger.evidence([words for words, _ in some]) for some in _in_parts(docs, y, empty=True)])
    head = np.zeros(3)
    for _ in range(30):  # Newton steps of a ridge logistic regression
        p = 1 / (1 + np.exp(-np.clip(x @ head, -30, 30)))
        h = (x * (stands * p * (1 - p))[:, None]).T @ x + np.diag([1e-3, 0.1, 0.1])
        head += np.linalg.solve(h, x.T @ (stands * (y - p)) - np.array([1e-3, 0.1, 0.1]) * head)
    model.head = tuple(head.tolist())
    return model


class _Tagger:
    def __init__(self, model: Model):
        self.model = model
        self.known: dict[str, float] = {}
        self.lead = {f[:4] for f in model.weights}

    def emissions(self, words: list[str]) -> np.ndarray:
        known = self.known
        if len(known) > CACHE_ENTRIES:
            known.clear()
        for w in {w for w in words if w not in known}:
            known[w] = self.model.bias + (sum(self.model.weights.get(f, 0.0) for f in features(w)) if w[:4] in self.lead else 0.0)
        return np.fromiter(map(known.__getitem__, words), np.float64, len(words))

    def marginals(self, docs: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.fromiter(map(len, docs), np.int64, len(docs))
        at = np.repeat(np.arange(len(docs)), sizes)
        starts = np.zeros(len(at), bool)
        starts[(np.cumsum(sizes) - sizes)[sizes > 0]] = True
        emission = self.emissions([w for d in docs for w in d])
        return forward_backward(emission, starts, self.model.trans)[0], at

    def evidence(self, docs: list[list[str]]) -> np.ndarray:
        p, at = self.marginals(docs)
        return _evidence(p, at, len(docs))

    def score(self, texts: list[str]) -> tuple[np.ndarray, list[list[dict]]]:
        """Scores, and spans as code-point offsets with their highest marginal."""
        docs = [tokens(t) for t in texts]
        p, at = self.marginals(docs)
        scores = 1 / (1 + np.exp(-np.clip(_evidence(p, at, len(docs)) @ np.array(self.model.head), -30, 30)))
        first = np.searchsorted(at, np.arange(len(docs)))
        spans: list[list[dict]] = [[] for _ in docs]
        toxic: dict[int, list[int]] = {}
        for k in np.flatnonzero(p >= 0.5).tolist():
            toxic.setdefault(int(at[k]), []).append(k)
        for d, hits in toxic.items():
            low = texts[d].lower()
            places = [m.span() for m in _WORD.finditer(low if len(low) == len(texts[d]) else texts[d])]
            last = -2
            for k in hits:
                start, end = places[k - int(first[d])]
                if k == last + 1:
                    spans[d][-1] |= {"end": end, "p": max(spans[d][-1]["p"], float(p[k]))}
                else:
                    spans[d].append({"start": start, "end": end, "p": float(p[k])})
                last = k
        return scores, spans


def tag(docs: DataFrame, model: Model) -> DataFrame:
    """docs with `toxicity` (0 to 1) and `toxic_spans`. Offsets are code points of the text as it is."""
    kept = docs.drop("toxicity", "toxic_spans")
    schema = widened(kept, "toxicity double, toxic_spans array<struct<start:int,end:int,p:double>>")
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = _Tagger(model)
        for batch in batches:
            for k in range(0, batch.num_rows, 250):
                part = batch.slice(k, 250)
                scores, spans = tagger.score(texts_of(part))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scores), pa.array(spans, kind)], [*part.schema.names, "toxicity", "toxic_spans"])

    return map_batches(kept, run, schema)


def clean(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs, unchanged, whose toxicity is under the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = _Tagger(model)
        for batch in batches:
            for k in range(0, batch.num_rows, 250):
                part = batch.slice(k, 250)
                yield part.filter(pa.array(tagger.score(texts_of(part))[0] < threshold))

    return map_batches(docs, run, docs.schema)


def fit_on(docs: DataFrame, labels: DataFrame, at_most: int = MAX_LABELLED) -> Model:
    """Learns from about at_most of the labelled rows that are not held out."""
    rows = labelled_sample(docs, labels, "toxic", at_most).orderBy("doc_id").select("text", "y", "w").toArrow()
    return fit(r for batch in rows.to_batches() for r in zip(*(c.to_pylist() for c in batch.columns), strict=True))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit_on(docs, table(spark, sf_dir, "labels"))
    tagged = tag(docs.select("doc_id", "text"), model)
    return tagged.select(
        "doc_id",
        held_out(4, 2).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= THRESHOLD).cast("int").alias("predicted"),
        F.size("toxic_spans").alias("n_spans"),
    )


QUERIES = {"op9_toxicity": op9_toxicity}
ORACLES: dict[str, str] = {}
