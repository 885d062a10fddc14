"""Benchmark decontamination by templates.

Texts are cut at white space. Numbers, units after numbers, and names (capitalised words inside a sentence) become typed
placeholders; other words are lower-cased and stripped of marks. Windows of WINDOW template words are hashed. Windows of
documents that a fixed-size bit table says may be the benchmark's are hash-joined with the benchmark's own. For each
document and item: coverage is the share of the item's windows that the document has; consistency is the share of the item's
placeholder values that stand for a single value each throughout the document. A document is contaminated by an item if its
coverage is COVERAGE or more and its consistency CONSISTENCY or more; if values differ, it re-parameterises the item.

A capitalised word that opens a sentence may be a name or not, so windows over it are hashed once for each reading, on both
sides. Readings as plain words decide which of an item's windows count; readings as names may have one plain word less.

Windows with fewer than LITERALS plain words say too little and are left out; items shorter than a window have one window,
which documents match at that length. Items with no other windows, such as calculations, have windows of their literal words
instead, marks between them included, so copies are found but not re-parameterised ones; of these, items of fewer than LITERALS
words are left out, since documents have single numbers and names for many reasons. Each window counts once for a document however often it occurs, so tables of
numbers and repeated passages yield no pairs beyond one.

Cases: null and empty texts have no windows; a null doc_id is a document like others; rows that share a doc_id count as one
document; repeated items are reported each; an empty table on either side gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import column_of, fresh, map_batches, settled, sized, table

WINDOW, LITERALS, COVERAGE, CONSISTENCY = 5, 3, 0.8, 0.5
#: Bits of the table of benchmark windows: 4 MB, whatever the input.
TABLE_BITS = 1 << 25
#: White-space stretches that a worker keeps analysed.
CACHE_ENTRIES = 400_000

# Number words and units.
NUMBER_WORDS = frozenset("zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion".split())
UNITS = frozenset("mm cm m km in ft yd mi mg g kg t lb lbs oz ml l s sec min h hr hrs day days week weeks month months year years kwh mwh w kw mw j kj v a hz k c f meter meters metre metres kilometer kilometers kilometre kilometres gram grams kilogram kilograms liter liters litre litres second seconds minute minutes hour hours mile miles inch inches foot feet pound pounds dollar dollars euro euros cent cents percent % $ € £".split())
_PLAIN, _NUMBER, _UNIT, _CAPITAL, _NONE = range(5)
_MARKS = ".,;:!?\"'()[]{}<>«»“”‘’„…*#|&-–—_/\\$%€£+=~^`@¿¡"

#: Stripped from literal words; signs and currencies stay.
_PUNCTUATION = ".,;:!?\"'()[]{}«»“”‘’„…"


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_PLACEHOLDER = np.array([0, 0x9D39247E33776D41, 0x2AF7398005AAA5C7, 0x44DB015024623547, 0], np.uint64)


class Templates:
    """Analyses stretches and makes windows; made once in each worker."""

    def __init__(self) -> None:
        self.known: dict[str, int] = {}
        self.hash: list[int] = []
        self.kind: list[int] = []
        self.ends: list[bool] = []
        self.literal: list[int] = []

    def _analyse(self, stretch: str) -> int:
        import xxhash

        core = stretch.strip(_MARKS)
        if not core:
            kind = _UNIT if stretch.lower() in UNITS else _NONE
            core = stretch
        elif core[0].isdigit() or core.lower() in NUMBER_WORDS:
            kind = _NUMBER
        elif core.lower() in UNITS:
            kind = _UNIT
        else:
            kind = _CAPITAL if core[0].isupper() and not core.isupper() else _PLAIN
        self.hash.append(xxhash.xxh64_intdigest(core.lower().encode(), 17))
        self.kind.append(kind)
        self.ends.append(stretch.rstrip("\"')]”’»")[-1:] in (".", "!", "?", ":"))
        self.literal.append(xxhash.xxh64_intdigest((stretch.strip(_PUNCTUATION) or stretch).lower().encode(), 19))
        self.known[stretch] = k = len(self.hash) - 1
        return k

    def read(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[str]]:
        """Template words of all texts end to end: hash, kind, text number, whether it is plain but may be a name; and the stretches they come from."""
        if len(self.known) > CACHE_ENTRIES:
            self.__init__()
        split = [t.split() for t in texts]
        stretches = [s for ss in split for s in ss]
        known = self.known
        for s in {s for s in stretches if s not in known}:
            self._analyse(s)
        at = np.fromiter(map(known.__getitem__, stretches), np.int64, len(stretches))
        kind, ends = np.array(self.kind, np.int8)[at] if len(at) else np.zeros(0, np.int8), np.array(self.ends, bool)[at] if len(at) else np.zeros(0, bool)
        text = np.repeat(np.arange(len(texts)), np.fromiter(map(len, split), np.int64, len(split)))
        self.last = at, text
        use = np.flatnonzero(kind != _NONE)
        # A stretch of marks alone is no word, but may end a sentence.
        ended = np.maximum.accumulate(np.where(kind != _NONE, np.arange(len(kind)), -1)) if len(kind) else np.zeros(0, np.int64)
        after = np.bincount(ended[ends & (ended >= 0)], minlength=len(kind)).astype(bool) if len(kind) else np.zeros(0, bool)
        h, kind, text = (np.array(self.hash, np.uint64)[at] if len(at) else np.zeros(0, np.uint64))[use], kind[use], text[use]
        first = np.ones(len(use), bool)
        first[1:] = text[1:] != text[:-1]
        prior_end = np.ones(len(use), bool)
        prior_end[1:] = after[use][:-1] | first[1:]
        prior_number = np.zeros(len(use), bool)
        prior_number[1:] = (kind[:-1] == _NUMBER) & ~first[1:]
        kind = np.where((kind == _UNIT) & ~prior_number, _PLAIN, kind)
        either = (kind == _CAPITAL) & prior_end
        kind = np.where(either, _PLAIN, kind)
        h = np.where(kind == _PLAIN, h, _PLACEHOLDER[kind])
        return h, kind, text, either, [stretches[k] for k in use.tolist()] if len(use) != len(stretches) else stretches

    def literals(self) -> tuple[np.ndarray, np.ndarray]:
        """Of the texts read last: the hash of each stretch, and its text number."""
        at, text = self.last
        return np.array(self.literal, np.uint64)[at] if len(at) else np.zeros(0, np.uint64), text


def _hashes(h: np.ndarray, length: int) -> np.ndarray:
    """A hash of each run of `length` template words."""
    n = len(h) - length + 1
    out = np.full(max(n, 0), length, np.uint64)
    for k in range(length):
        out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + h[k : k + n] if n > 0 else out)
    return out


def _windows(h: np.ndarray, kind: np.ndarray, text: np.ndarray, length: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the windows that lie in one text and have `least` plain words."""
    n = len(h) - length + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    plain = np.concatenate([[0], np.cumsum(kind == _PLAIN)])
    ok = (text[:n] == text[length - 1 :]) & (plain[length:] - plain[:n] >= least)
    return np.flatnonzero(ok), _hashes(h, length)[ok]


def _least(length: int, as_names: bool) -> int:
    """Plain words that a window must have."""
    return LITERALS - 1 if as_names and length == WINDOW else min(LITERALS, length)


def _readings(h: np.ndarray, either: np.ndarray, starts: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(starts, hashes, names) of windows once more for each choice of words that may be names and are read so; bit k of names is word k."""
    bits = np.zeros(len(starts), np.int64)
    for k in range(length):
        bits |= either[starts + k].astype(np.int64) << k
    starts, bits = starts[bits > 0], bits[bits > 0]
    for names in range(1, 1 << length):
        own = starts[(bits & names) == names]
        if len(own):
            out = np.full(len(own), length, np.uint64)
            for k in range(length):
                out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + (_PLACEHOLDER[_CAPITAL] if names >> k & 1 else h[own + k]))
            yield own, out, names


def _literal_windows(reader: Templates, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the windows of literal words of the texts that reader read last."""
    h, text = reader.literals()
    n = len(h) - length + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    ok = text[:n] == text[length - 1 :]
    return np.flatnonzero(ok), _hashes(h, length)[ok]


def _slots(words: list[str], kind: np.ndarray, start: int, length: int, names: int = 0) -> list[str]:
    return [words[start + k].strip(_MARKS).lower() or words[start + k] for k in range(length) if kind[start + k] != _PLAIN or names >> k & 1]


_SCHEMA = pa.schema([("hash", pa.int64()), ("at", pa.int32()), ("slots", pa.list_(pa.string()))])


def item_windows(items: DataFrame) -> DataFrame:
    """(item_id, hash, at, slots, opens, length) of all windows of the benchmark, in all readings. opens tells which slots open a sentence; length is negative for windows of literal words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Templates()
        for batch in batches:
            for item, text in zip(column_of(batch, "item_id").to_pylist(), column_of(batch, "text").to_pylist(), strict=True):
                h, kind, place, either, words = reader.read([text or ""])
                length = min(WINDOW, len(h))
                if not length:
                    continue
                starts, hashes = _windows(h, kind, place, length, _least(length, False))
                rows = [(x, s, _slots(words, kind, s, length), [False] * int((kind[s : s + length] != _PLAIN).sum())) for s, x in zip(starts.tolist(), hashes.view(np.int64).tolist(), strict=True)]
                for own, hashes, names in _readings(h, either, starts, length):
                    for s, x in zip(own.tolist(), hashes.view(np.int64).tolist(), strict=True):
                        if (kind[s : s + length] == _PLAIN).sum() - names.bit_count() >= _least(length, True):
                            rows.append((x, s, _slots(words, kind, s, length, names), [bool(names >> k & 1) for k in range(length) if kind[s + k] != _PLAIN or names >> k & 1]))
                if not rows:
                    size = min(WINDOW, len(reader.last[0]))
                    starts, hashes = _literal_windows(reader, size)
                    rows = [(x, s, [], []) for s, x in zip(starts.tolist(), hashes.view(np.int64).tolist(), strict=True) if size >= LITERALS]
                    length = -size
                if rows:
                    x, s, v, o = zip(*rows)
                    yield pa.RecordBatch.from_arrays([pa.array([item] * len(rows), pa.int64()), pa.array(x, pa.int64()), pa.array(s, pa.int32()), pa.array(v, pa.list_(pa.string())), pa.array(o, pa.list_(pa.bool_())), pa.array([length] * len(rows), pa.int32())], ["item_id", "hash", "at", "slots", "opens", "length"])

    return map_batches(items.select(F.col("item_id").cast("long"), F.col("text").cast("string")), run, "item_id long, hash long, at int, slots array<string>, opens array<boolean>, length int")


def _bit_table(windows: DataFrame) -> tuple[bytes, list[int]]:
    """A bit for each window's hash, and the lengths that occur (WINDOW and below; negative for literal words). One table of fixed size comes from each partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, lengths = np.zeros(TABLE_BITS // 8, np.uint8), set()
        for batch in batches:
            at = batch.column(0).to_numpy().view(np.uint64) % np.uint64(TABLE_BITS)
            np.bitwise_or.at(bits, at >> np.uint64(3), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))
            lengths |= set(batch.column(1).to_pylist())
        if lengths:
            yield pa.RecordBatch.from_arrays([pa.array([bits.tobytes()], pa.binary()), pa.array([sorted(lengths)], pa.list_(pa.int32()))], ["bits", "lengths"])

    bits, lengths = np.zeros(TABLE_BITS // 8, np.uint8), set()
    for row in windows.select("hash", "length").coalesce(8).mapInArrow(run, "bits binary, lengths array<int>").toLocalIterator():
        bits |= np.frombuffer(row["bits"], np.uint8)
        lengths |= set(row["lengths"])
    return bits.tobytes(), sorted(lengths)


def candidate_windows(docs: DataFrame, bits: bytes, lengths: list[int]) -> DataFrame:
    """(doc_id, hash, slots): the documents' windows whose bit is set, each once for each text and choice of slot values."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, table_ = Templates(), np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            for k in range(0, batch.num_rows, 250):
                part = batch.slice(k, 250)
                ids = column_of(part, "doc_id").to_pylist()
                h, kind, text, either, words = reader.read([t or "" for t in column_of(part, "text").to_pylist()])
                rows: dict[tuple, None] = {}

                def known(starts: np.ndarray, hashes: np.ndarray) -> Iterator[tuple[int, int]]:
                    at = hashes % np.uint64(TABLE_BITS)
                    hit = (table_[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0
                    return zip(starts[hit].tolist(), hashes[hit].view(np.int64).tolist(), strict=True)

                for length in lengths:
                    if length < 0:
                        for s, x in known(*_literal_windows(reader, -length)):
                            rows[ids[reader.last[1][s]], x, ()] = None
                        continue
                    # The benchmark's windows that are too poor are not in the table; those left out here cannot be.
                    starts, hashes = _windows(h, kind, text, length, _least(length, True))
                    for own, x_, names in ((starts, hashes, 0), *_readings(h, either, starts, length)):
                        for s, x in known(own, x_):
                            rows[ids[text[s]], x, tuple(_slots(words, kind, s, length, names))] = None
                if rows:
                    d, x, v = zip(*rows)
                    yield pa.RecordBatch.from_arrays([pa.array(d, pa.int64()), pa.array(x, pa.int64()), pa.array([list(s) for s in v], pa.list_(pa.string()))], ["doc_id", "hash", "slots"])

    return map_batches(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, "doc_id long, hash long, slots array<string>")


def contaminated(docs: DataFrame, items: DataFrame, coverage: float = COVERAGE, consistency: float = CONSISTENCY) -> DataFrame:
    """(doc_id, item_id, matched, windows, coverage, consistency, verbatim) of each document and item that it gives away."""
    own = item_windows(items).distinct().persist()
    bits, lengths = _bit_table(own)
    # Read twice below, so written once: few windows have their bit set.
    found = settled(candidate_windows(docs, bits, lengths))
    sizes = own.groupBy("item_id").agg(F.countDistinct("at").alias("windows"))
    by_hash = own.groupBy("item_id", "hash", "slots", "opens").agg(F.collect_set("at").alias("places")).withColumnRenamed("slots", "item_slots")
    pairs = found.join(by_hash, "hash")
    per_place = pairs.select("doc_id", "item_id", F.explode("places").alias("at"), "slots", "item_slots")
    matched = per_place.groupBy("doc_id", "item_id", "at").agg(F.max((F.col("slots") == F.col("item_slots")).cast("int")).alias("same"))
    matched = matched.groupBy("doc_id", "item_id").agg(F.count(F.lit(1)).alias("matched"), F.min("same").alias("same"))
    values = pairs.where(F.size("slots") > 0).select("doc_id", "item_id", F.explode(F.arrays_zip("item_slots", "slots", "opens")).alias("x"))
    # What only opens sentences and stays as it is may be no name, so it says nothing of consistency.
    idle = F.min(F.col("x.opens") & (F.col("x.slots") == F.col("x.item_slots")))
    values = values.groupBy("doc_id", "item_id", F.col("x.item_slots").alias("value")).agg((F.min("x.slots") == F.max("x.slots")).cast("int").alias("one"), idle.alias("idle")).where(~F.col("idle"))
    steady = values.groupBy("doc_id", "item_id").agg(F.avg("one").alias("steady")).select(F.col("doc_id").alias("d"), F.col("item_id").alias("i"), "steady")
    both = matched.join(steady, F.col("doc_id").eqNullSafe(F.col("d")) & F.col("item_id").eqNullSafe(F.col("i")), "left").join(sizes.withColumnRenamed("item_id", "j"), F.col("item_id").eqNullSafe(F.col("j")))
    out = both.select("doc_id", "item_id", "matched", "windows", (F.col("matched") / F.col("windows")).alias("coverage"), F.coalesce("steady", F.lit(1.0)).alias("consistency"), (F.col("same") == 1).alias("verbatim"))
    return out.where((F.col("coverage") >= coverage) & ((F.col("consistency") >= consistency) | F.col("verbatim")))


def decontaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of docs, unchanged, that no item contaminates."""
    (lost,) = fresh(docs, "lost_doc")
    bad = settled(contaminated(docs, items).select(F.col("doc_id").alias(lost)).distinct())
    return docs.join(sized(bad), F.col("doc_id").eqNullSafe(F.col(lost)), "left_anti")


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {"op8_decontaminate": op8_decontaminate}
ORACLES: dict[str, str] = {}
