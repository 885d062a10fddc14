"""Language identification by unigram models over a fixed public vocabulary, with all segmentations summed.

For each language every piece of the vocabulary has a probability. A word's likelihood is the sum, over all ways to cut it
into pieces, of the product of their probabilities; a forward pass over the word's positions gives it. A text's likelihood
is the product over its words (runs of letters, in lower case, each after a word-start mark), so each worker keeps the
likelihoods of words it has met in a table of bounded size. Probabilities are learned by expectation-maximisation, whose
expected counts sum over all segmentations too, from a bounded sample of the documents that are not held out.

Characters that no piece covers cost a small constant in every language. Words of any length are summed whole: longer ones,
as in scripts without spaces, one by one in logarithms.

Cases: a null text, or one without a letter (Unicode's letters; numerals such as fractions are none), gives `und` and score 0; documents with a null language are not learned from;
without any language known every text with a letter gives `und` and 0; ties go to the language that sorts first; repeated
rows repeat; an empty table gives no rows.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import column_of, held_out, map_batches, table, widened

#: Documents that the probabilities are learned from, at most (about), in equal parts by language.
MAX_LEARNED = 4000
#: Words whose likelihoods a worker keeps in each of two generations; words that are summed at once.
CACHE_ENTRIES, AT_ONCE = 250_000, 5000
#: Words over this are summed in logarithms; probability of a character outside the vocabulary; rounds of learning.
WORD, UNSEEN, ROUNDS = 24, 1e-9, 3
START = "▁"
_ALMOST = re.compile(r"[^\W\d_]+")
_LETTERS = regex.compile(r"\p{L}+")


def words_of(text: str) -> list[str]:
    """Runs of letters in lower case."""
    found = _ALMOST.findall(low := text.lower())
    # The standard pattern takes numerals such as fractions for letters; few texts have any.
    return found if all(map(str.isalpha, found)) else _LETTERS.findall(low)


def vocabulary(path: str | None = None) -> list[str]:
    """The pieces of a sentencepiece model that are plain text, in lower case, without repeats."""
    import sentencepiece

    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = (sp.id_to_piece(k).lower() for k in range(sp.get_piece_size()) if not (sp.is_control(k) or sp.is_unknown(k) or sp.is_byte(k)))
    return list(dict.fromkeys(plain))


def numbered(pieces: list[str]) -> dict[str, int]:
    """Pieces by number; beginnings of pieces that are no pieces have number -1, and nothing else is in."""
    number = {piece[:n]: -1 for piece in pieces for n in range(1, len(piece))}
    number.update((piece, k) for k, piece in enumerate(pieces))
    return number


class Lattice:
    """All segmentations of some words: one edge for each piece at each place, sorted by the position where it ends."""

    def __init__(self, words: list[str], number: dict[str, int], unseen: int):
        get = number.get
        edges: list[tuple[int, int, int, int]] = []
        add = edges.append
        lasts = np.empty(len(words), np.int64)
        for w, word in enumerate(words):
            s = START + word
            n = lasts[w] = len(s)
            for a in range(n):
                p = get(s[a])
                add((a + 1, w, a, unseen if p is None or p < 0 else p))
                b = a + 1
                # No piece goes on where none begins like this.
                while p is not None and b < n:
                    b += 1
                    p = get(s[a:b])
                    if p is not None and p >= 0:
                        add((b, w, a, p))
        e = np.array(edges, np.int64).reshape(-1, 4)
        e = e[np.lexsort((e[:, 1], e[:, 0]))]
        self.end, self.word, self.start, self.piece = e.T
        self.lasts, self.size = lasts, int(lasts.max(initial=0)) + 1
        self.cuts = np.searchsorted(self.end, np.arange(self.size + 1))

    def forward(self, p: np.ndarray) -> np.ndarray:
        """p: probability of each piece and of an unseen character, by language. Sums for each prefix: [position, word, language]."""
        f = np.zeros((self.size, len(self.lasts), p.shape[1]))
        f[0] = 1
        for b in range(1, self.size):
            at = slice(self.cuts[b], self.cuts[b + 1])
            if at.start == at.stop:
                continue
            x = f[self.start[at], self.word[at]] * p[self.piece[at]]
            w = self.word[at]
            first = np.flatnonzero(np.append(True, w[1:] != w[:-1]))
            f[b, w[first]] = np.add.reduceat(x, first)
        return f

    def likelihoods(self, p: np.ndarray) -> np.ndarray:
        f = self.forward(p)
        return f[self.lasts, np.arange(len(self.lasts))]

    def expected(self, p: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Expected uses of each piece, in words that occur weight times, by language."""
        f = self.forward(p)
        total = f[self.lasts, np.arange(len(self.lasts))]
        back = np.zeros_like(f)
        back[self.lasts, np.arange(len(self.lasts))] = weight / np.maximum(total, 1e-300)
        out = np.zeros_like(p)
        for b in range(self.size - 1, 0, -1):
            at = slice(self.cuts[b], self.cuts[b + 1])
            x = p[self.piece[at]] * back[b, self.word[at]]
            np.add.at(out, self.piece[at], x * f[self.start[at], self.word[at]])
            np.add.at(back, (self.start[at], self.word[at]), x)
        return out


def _pieces_at(s: str, a: int, number: dict[str, int], unseen: int) -> Iterator[tuple[int, int]]:
    """(end, piece) of each piece of s that begins at a."""
    p = number.get(s[a])
    yield a + 1, unseen if p is None or p < 0 else p
    b = a + 1
    while p is not None and b < len(s):
        b += 1
        p = number.get(s[a:b])
        if p is not None and p >= 0:
            yield b, p


def long_forward(word: str, number: dict[str, int], log_p: np.ndarray) -> np.ndarray:
    """The logarithms of the sums for each prefix of one word of any length: [position, language]."""
    s, unseen = START + word, len(log_p) - 1
    f = np.full((len(s) + 1, log_p.shape[1]), -np.inf)
    f[0] = 0
    for a in range(len(s)):
        for b, piece in _pieces_at(s, a, number, unseen):
            np.logaddexp(f[b], f[a] + log_p[piece], out=f[b])
    return f


def long_expected(word: str, number: dict[str, int], p: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Expected uses of each piece in one word of any length that occurs weight times, by language."""
    s, unseen, log_p, out = START + word, len(p) - 1, np.log(p), np.zeros_like(p)
    f = long_forward(word, number, log_p)
    back = np.full_like(f, -np.inf)
    back[-1] = 0
    for a in range(len(s) - 1, -1, -1):
        for b, piece in _pieces_at(s, a, number, unseen):
            after = log_p[piece] + back[b]
            np.logaddexp(back[a], after, out=back[a])
            out[piece] += weight * np.exp(f[a] + after - f[-1])
    return out


@dataclass
class Model:
    languages: list[str]
    pieces: list[str]
    #: probability of each piece and of an unseen character, by language
    p: np.ndarray
    log_prior: np.ndarray


def fit(rows: Iterable[tuple[str | None, str | None]], pieces: list[str], totals: dict[str, int] | None = None) -> Model:
    """rows: (text, language); totals: how many documents each language has, if rows are a sample by language."""
    counts: dict[str, Counter[str]] = {}
    docs: Counter[str] = Counter()
    for text, lang in rows:
        if lang is not None and text:
            counts.setdefault(lang, Counter()).update(words_of(text))
            docs[lang] += 1
    languages = sorted(lang for lang in counts if counts[lang])
    width = len(languages)
    p = np.full((len(pieces) + 1, width), 1 / (len(pieces) + 1))
    p[-1] = UNSEEN
    if not width:
        return Model([], pieces, p, np.zeros(0))
    words = sorted(set().union(*counts.values()), key=lambda w: (len(w), w))
    number = numbered(pieces)
    short = sum(len(w) <= WORD for w in words)
    weights = lambda some: np.array([[counts[lang][w] for lang in languages] for w in some], float)
    for _ in range(ROUNDS):
        # Lattices are made anew in each round, so that memory does not grow with the number of words.
        uses = np.full_like(p, 0.01)
        for k in range(0, short, AT_ONCE):
            some = words[k : min(short, k + AT_ONCE)]
            uses += Lattice(some, number, len(pieces)).expected(p, weights(some))
        for word in words[short:]:
            uses += long_expected(word, number, p, weights([word])[0])
        p = uses / uses.sum(0)
        p[-1] = UNSEEN
    of = totals or docs
    total = sum(of[lang] for lang in languages)
    return Model(languages, pieces, p, np.log([of[lang] / total for lang in languages]))


class Identifier:
    """Scores texts with one model; made once in each worker."""

    def __init__(self, model: Model):
        self.model = model
        self.number = numbered(model.pieces)
        self.log_p = np.log(model.p)
        # A young and an old generation of words, and their log likelihoods.
        self.known: dict[str, int] = {}
        self.old: dict[str, int] = {}
        self.logs = self.old_logs = np.zeros((0, len(model.languages)))

    def _learn(self, words: list[str]) -> None:
        again = [w for w in words if w in self.old]
        fresh = [w for w in words if w not in self.old]
        fresh.sort(key=len)
        short = sum(len(w) <= WORD for w in fresh)
        logs = [self.old_logs[[self.old[w] for w in again]]] if again else []
        for k in range(0, short, AT_ONCE):
            some = Lattice(fresh[k : min(short, k + AT_ONCE)], self.number, len(self.model.pieces)).likelihoods(self.model.p)
            logs.append(np.log(np.maximum(some, 1e-300)))
        logs += [long_forward(w, self.number, self.log_p)[-1:] for w in fresh[short:]]
        self.known.update(zip([*again, *fresh], range(len(self.logs), len(self.logs) + len(words)), strict=True))
        self.logs = np.concatenate([self.logs, *logs])

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        docs = [words_of(t) for t in texts]
        langs, scores = ["und"] * len(texts), np.zeros(len(texts))
        if not self.model.languages:
            return langs, scores
        if len(self.known) > CACHE_ENTRIES:
            self.old, self.old_logs, self.known, self.logs = self.known, self.logs, {}, self.logs[:0]
        known = self.known
        flat = [w for d in docs for w in d]
        if new := list({w for w in flat if w not in known}):
            self._learn(new)
        sizes = np.fromiter(map(len, docs), np.int64, len(docs))
        has = np.flatnonzero(sizes)
        if len(has):
            ids = np.fromiter(map(known.__getitem__, flat), np.int64, len(flat))
            z = np.add.reduceat(self.logs[ids], (np.cumsum(sizes) - sizes)[has]) + self.model.log_prior
            best = z.argmax(1)
            top = 1 / np.exp(z - z[np.arange(len(has)), best][:, None]).sum(1)
            for k, b, s in zip(has.tolist(), best.tolist(), top.tolist(), strict=True):
                langs[k], scores[k] = self.model.languages[b], s
        return langs, scores


#: The identifier that this worker process made last, by the name of its model. Later tasks of the same process find their words in it.
_MADE: dict[str, Identifier] = {}


def _identifier(name: str, model: Broadcast) -> Identifier:
    if name not in _MADE:
        _MADE.clear()
        _MADE[name] = Identifier(model.value)
    return _MADE[name]


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """docs with `lang_pred` and `lang_score`, the posterior probability of the predicted language."""
    kept = docs.drop("lang_pred", "lang_score")
    # The model's size is that of the vocabulary times the languages, whatever the input's size.
    shared, name = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        identifier = _identifier(name, shared)
        for batch in batches:
            for k in range(0, batch.num_rows, 250):
                part = batch.slice(k, 250)
                langs, scores = identifier.predict([t or "" for t in column_of(part, "text").to_pylist()])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(langs), pa.array(scores)], [*part.schema.names, "lang_pred", "lang_score"])

    return map_batches(kept, run, widened(kept, "lang_pred string, lang_score double"))


def fit_on(docs: DataFrame, learn: Column, path: str | None = None, at_most: int = MAX_LEARNED) -> Model:
    """Learns from about at_most of the documents for which `learn` holds, in equal parts by language, chosen by a hash of doc_id."""
    rows = docs.where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    totals = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not totals:
        return fit([], vocabulary(path))
    shares = [(lang, float(min(1.0, at_most / len(totals) / n))) for lang, n in totals.items()]
    of_lang = docs.sparkSession.createDataFrame(shares, "lang string, _share double")
    rows = rows.join(F.broadcast(of_lang), "lang").where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < F.col("_share") * 1_000_000)
    taken = rows.select("text", "lang").toArrow()
    return fit((r for batch in taken.to_batches() for r in zip(*(c.to_pylist() for c in batch.columns), strict=True)), vocabulary(path), totals)


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit_on(docs, ~held_out(5, 0))
    return identify(docs.select("doc_id", "text"), model).select("doc_id", held_out(5, 0).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


QUERIES = {"op6_language": op6_language}
ORACLES: dict[str, str] = {}
