"""Removal of repeated 100-byte strings by grouping anchors, in place of distributed prefix doubling.

A rank is the class of the bytes that start at a position. Doubling ranks at all positions would sort some thirty bytes a
byte of text in every round; here positions are thinned first, in a way that equal strings agree on:

* Of the 69 grams of 32 bytes in a 100-byte window, the one with the least hash (leftmost if equal) is the window's anchor.
  Equal windows have their anchors at the same offset, and every window has one, so comparing windows with equal anchors
  compares all equal windows. There is about one anchor in 35 bytes, and its windows are neighbours.
* Round 1 ranks anchors by their gram. Anchors whose rank is unique over all documents drop out.
* Round 2 ranks the others by the pair of gram and surroundings, which is all bytes of the anchor's windows. Of equal pairs
  all but the first are repeats past the threshold, whatever else there is. The firsts go on.
* Round 3 ranks, for anchors of one gram with several surroundings, each window at its offset: (gram, offset, 100 bytes). Of
  equal windows all but the first are repeats.

Ranks are 64-bit fingerprints, taken together with the gram's. Rounds pack rows by rank into binary blocks, which Spark
shuffles and numpy sorts. Each task first settles what it can among its own rows, so a gram that many documents share
reaches a task once for each block of documents. Grams with more than HOT surroundings skip the packed rounds: their
windows are ranked by a Spark aggregation, which takes partial minima, and a join that splits skewed keys.

Cases: null and empty texts have no bytes; texts under 100 bytes lose nothing; texts of any length are read in overlapping
pieces; rows that share a doc_id are equally early, so they do not make each other's strings repeats; a null doc_id counts as
smallest; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import column_of, flat_bytes, map_batches, settled, table

LENGTH, GRAM = 100, 32
_GRAMS = LENGTH - GRAM + 1
#: Bytes of text that a task works on at once; of text that a packed partition stands for; most surroundings of a gram there.
PIECE, SHARE, HOT = 1 << 20, 8 << 20, 20_000
#: Bits of the table of repeated grams, at most: 32 MB. Fuller tables let more anchors through to round 2, where unique ones drop out.
TABLE_BITS = 1 << 28
FIRST = -(1 << 63)
_POSITION = np.uint64((1 << 23) - 1)
_U = np.uint64
_BYTES = np.random.default_rng(11).integers(1, 2**63, 256, dtype=np.uint64)
_BASE = 0x2545F4914F6CDD1D
_BACK = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    np.multiply.accumulate(np.full(n - 1, base, np.uint64), out=out[1:])
    return out


_size = PIECE + (64 << 10)
_UP, _DOWN = _powers(_BASE, _size), _powers(_BACK, _size)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _sums(data: np.ndarray) -> np.ndarray:
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * _UP[: len(data)], out=out[1:])
    return out


def _fingerprint(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Of the bytes from start to end; sums: of the data they lie in."""
    return _mixed((sums[end] - sums[start]) * _DOWN[start] + (end - start).astype(np.uint64))


class Anchors:
    """The anchors of some texts: gram, text (row), place of the anchor, first and last window, and the shape of their bytes."""

    def __init__(self, data: np.ndarray, row: np.ndarray, begin: np.ndarray, shift: np.ndarray):
        """data: pieces of text end to end; row, begin, shift of each piece: its text, its place in data, its place in the text."""
        self.data, self.row_of, self.begin, self.shift = data, row, begin, shift
        n = len(data) - LENGTH + 1
        none = np.zeros(0, np.int64)
        self.gram, self.shape = none.view(np.uint64), none.view(np.uint64)
        self.piece = self.anchor = self.first = self.last = none
        if n <= 0:
            return
        self.sums = _sums(data)
        places = np.arange(len(data) - GRAM + 1)
        gram = _fingerprint(self.sums, places, places + GRAM)
        least = (gram & ~_POSITION) | places.astype(np.uint64)
        width = 1
        while 2 * width <= _GRAMS:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        rest = _GRAMS - width
        least = np.minimum(least[: len(least) - rest], least[rest:]) if rest else least
        at = (least & _POSITION).astype(np.int64)[:n]
        piece = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, len(data))))
        inside = piece[:n] == piece[LENGTH - 1 :]
        change = np.ones(n, bool)
        change[1:] = (at[1:] != at[:-1]) | (piece[1:n] != piece[: n - 1])
        first = np.flatnonzero(change & inside)
        following = np.append(np.flatnonzero(change), n)
        # The windows of an anchor end before the next anchor's, or where windows no longer fit into the piece.
        stop = following[np.searchsorted(following, first, side="right")]
        fits = np.append(begin, len(data))[piece[first] + 1] - LENGTH + 1
        self.first, self.last = first, np.minimum(stop, fits) - 1
        self.anchor, self.piece = at[first], piece[first]
        self.gram = gram[self.anchor]
        around = _fingerprint(self.sums, first, self.last + LENGTH)
        self.shape = _mixed(around + self.gram + (self.anchor - first).astype(np.uint64))

    def starts(self) -> np.ndarray:
        """Place of the first window in its text."""
        return self.first - self.begin[self.piece] + self.shift[self.piece]


def _pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[Anchors, np.ndarray, np.ndarray]]:
    """Anchors of the texts of some rows at a time, with the rows' doc_id and a hash of the text."""
    held: list[tuple[int, int, bytes | np.ndarray]] = []
    size = 0

    def settle() -> tuple[Anchors, np.ndarray, np.ndarray]:
        parts, row, shift = [], [], []
        for k, (_, _, text, offset) in enumerate(held):
            parts.append(text)
            row.append(k)
            shift.append(offset)
        sizes = np.array([len(p) for p in parts], np.int64)
        anchors = Anchors(np.concatenate(parts) if parts else np.zeros(0, np.uint8), np.array(row), np.cumsum(sizes) - sizes, np.array(shift, np.int64))
        return anchors, np.array([h[0] for h in held], np.int64), np.array([h[1] for h in held], np.int64)

    for batch in batches:
        data, offsets = flat_bytes(batch)
        ids = column_of(batch, "doc_id").fill_null(FIRST).to_numpy(zero_copy_only=False)
        marks = column_of(batch, "mark").to_numpy(zero_copy_only=False)
        for k in range(batch.num_rows):
            a, b = int(offsets[k]), int(offsets[k + 1])
            for start in range(a, b - LENGTH + 1, PIECE // 2):
                piece = data[start : min(b, start + PIECE // 2 + LENGTH - 1)].copy()
                if size + len(piece) > PIECE:
                    yield settle()
                    held, size = [], 0
                held.append((int(ids[k]), int(marks[k]), piece, start - a))
                size += len(piece)
    if held:
        yield settle()


def _pack(*arrays: np.ndarray) -> bytes:
    raw = struct.pack(f"<{len(arrays)}Q", *(a.nbytes for a in arrays)) + b"".join(a.tobytes() for a in arrays)
    return struct.pack("<Q", len(raw)) + pa.compress(raw, codec="zstd", asbytes=True)


def _unpack(data: bytes, *kinds: str) -> list[np.ndarray]:
    raw = pa.decompress(data[8:], struct.unpack("<Q", data[:8])[0], codec="zstd", asbytes=True)
    sizes = struct.unpack(f"<{len(kinds)}Q", raw[: 8 * len(kinds)])
    out, at = [], 8 * len(kinds)
    for kind, n in zip(kinds, sizes, strict=True):
        out.append(np.frombuffer(raw[at : at + n], kind))
        at += n
    return out


def _groups(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A sorting order by keys (the first counts most) and, in that order, where a new value of the keys starts."""
    order = np.lexsort(keys[::-1])
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.logical_or.reduce([k[order][1:] != k[order][:-1] for k in keys])
    return order, new


def _by_bucket(bucket: np.ndarray, order: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each bucket that occurs, with its part of `order`, which sorts by bucket. However many buckets there are, this takes as many
    turns as a piece has anchors at most."""
    ordered = bucket[order]
    starts = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])) if len(ordered) else np.zeros(0, np.int64)
    for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(ordered)], strict=True) if len(starts) else ():
        yield int(ordered[a]), order[a:b]


def _input(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).withColumn("mark", F.xxhash64("text"))


def _repeated_grams(docs: DataFrame, parts: int, hot: int) -> DataFrame:
    """(gram, hot) of grams that are anchors more than once. hot: with more than `hot` surroundings, counted by block of documents."""

    def give(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for anchors, _, _ in _pieces(batches):
            order, new = _groups(anchors.gram, anchors.shape)
            gram = anchors.gram[order]
            _, first, uses = np.unique(gram, return_index=True, return_counts=True)
            shapes = np.add.reduceat(new, first) if len(first) else np.zeros(0, np.int64)
            gram = gram[first]
            bucket = gram % _U(parts)
            order = np.argsort(bucket, kind="stable")
            rows = []
            for k, own in _by_bucket(bucket, order):
                many = uses[own] > 1
                # Incompressible, so plain bytes.
                rows.append((k, gram[own[~many]].tobytes(), gram[own[many]].tobytes(), shapes[own[many]].astype(np.uint32).tobytes()))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.binary(), pa.binary(), pa.binary()), strict=True)], ["bucket", "once", "many", "shapes"])

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, shapes, twice = [], [], []
        for batch in batches:
            for once, many, n in zip(*(column_of(batch, c).to_pylist() for c in ("once", "many", "shapes")), strict=True):
                once, many = np.frombuffer(once, np.uint64), np.frombuffer(many, np.uint64)
                seen += [once, many]
                shapes += [np.ones(len(once), np.int64), np.frombuffer(n, np.uint32).astype(np.int64)]
                twice += [np.zeros(len(once), bool), np.ones(len(many), bool)]
        if not seen:
            return
        gram, shapes, twice = map(np.concatenate, (seen, shapes, twice))
        order = np.argsort(gram, kind="stable")
        gram = gram[order]
        at = np.flatnonzero(np.append(True, gram[1:] != gram[:-1]))
        again = (np.diff(np.append(at, len(gram))) > 1) | np.logical_or.reduceat(twice[order], at)
        total = np.add.reduceat(shapes[order], at)
        yield pa.RecordBatch.from_arrays([pa.array(gram[at[again]].view(np.int64).copy()), pa.array(total[again] > hot)], ["gram", "hot"])

    packed = map_batches(_input(docs), give, "bucket int, once binary, many binary, shapes binary")
    return packed.repartition(parts, "bucket").mapInArrow(rank, "gram long, hot boolean")


def _bit_tables(grams: DataFrame) -> tuple[bytes, bytes]:
    """Bits of all repeated grams and of the hot ones. Partitions send tables of fixed size, merged one at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = np.zeros((2, TABLE_BITS // 8), np.uint8)
        some = False
        for batch in batches:
            gram, hot = batch.column(0).to_numpy().view(np.uint64), batch.column(1).to_numpy(zero_copy_only=False)
            some |= len(gram) > 0
            for t, own in zip(tables, (gram, gram[hot]), strict=True):
                at = own % _U(TABLE_BITS)
                np.bitwise_or.at(t, at >> _U(3), _U(1).astype(np.uint8) << (at & _U(7)).astype(np.uint8))
        if some:
            yield pa.RecordBatch.from_arrays([pa.array([pa.compress(t.tobytes(), codec="zstd", asbytes=True)], pa.binary()) for t in tables], ["all", "hot"])

    out = np.zeros((2, TABLE_BITS // 8), np.uint8)
    for row in grams.coalesce(6).mapInArrow(run, "all binary, hot binary").toLocalIterator():
        for t, x in zip(out, row, strict=True):
            t |= np.frombuffer(pa.decompress(bytes(x), TABLE_BITS // 8, codec="zstd", asbytes=True), np.uint8)
    return tuple(pa.compress(t.tobytes(), codec="zstd", asbytes=True) for t in out)


def _opened(data: bytes) -> np.ndarray:
    return np.frombuffer(pa.decompress(data, TABLE_BITS // 8, codec="zstd", asbytes=True), np.uint8)


def _in_table(bits: np.ndarray, gram: np.ndarray) -> np.ndarray:
    at = gram % _U(TABLE_BITS)
    return (bits[at >> _U(3)] >> (at & _U(7)).astype(np.uint8)) & 1 > 0


def _run_rows(doc: np.ndarray, mark: np.ndarray, start: np.ndarray, stop: np.ndarray) -> pa.RecordBatch | None:
    """One row for each document: its byte ranges, as 32-bit or longer integers end to end."""
    if not len(doc):
        return None
    order, new = _groups(doc, mark)
    at = np.flatnonzero(new)
    ends = np.append(at[1:], len(order))
    both = np.stack([start, stop], 1)[order]
    runs = [both[a:b].astype("<i8").tobytes() for a, b in zip(at.tolist(), ends.tolist(), strict=True)]
    first = order[at]
    return pa.RecordBatch.from_arrays([pa.array([-1] * len(at), pa.int32()), pa.array(doc[first]), pa.array(mark[first]), pa.array(runs, pa.binary())], ["bucket", "doc_id", "mark", "payload"])


_ROW = "bucket int, doc_id long, mark long, payload binary"
_MEMBER = ("<u8", "<i8", "<i8", "<i8", "<u1", "<u1", "<u1")


def _repeats(docs: DataFrame, tables: tuple[bytes, bytes], parts: int) -> DataFrame:
    """(doc_id, mark, payload): byte ranges that repeat earlier ones, by rounds 2 and 3."""
    shared = docs.sparkSession.sparkContext.broadcast(tables)

    def give(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        live_table, hot_table = map(_opened, shared.value)
        for a, ids, marks in _pieces(batches):
            if not len(a.gram):
                continue
            own, start = a.row_of[a.piece], a.starts()
            doc, mark = ids[own], marks[own]
            order = np.lexsort((start, doc, a.shape))
            shape = a.shape[order]
            lead = np.append(True, shape[1:] != shape[:-1])
            best = order[np.maximum.accumulate(np.where(lead, np.arange(len(order)), 0))]
            later = order[(doc[order] != doc[best]) | (start[order] != start[best])]
            if (rows := _run_rows(doc[later], mark[later], start[later], start[later] + (a.last - a.first)[later] + LENGTH)) is not None:
                yield rows
            keep = order[lead]
            keep = keep[_in_table(live_table, a.gram[keep]) & ~_in_table(hot_table, a.gram[keep])]
            bucket = (a.gram[keep] % _U(parts)).astype(np.int64)
            out = []
            for k, own in _by_bucket(bucket, np.argsort(bucket, kind="stable")):
                m = keep[own]
                width = a.last[m] - a.first[m] + LENGTH
                inside = np.arange(int(width.sum())) - np.repeat(np.cumsum(width) - width, width)
                around = a.data[np.repeat(a.first[m], width) + inside]
                out.append((k, _pack(a.gram[m], doc[m], mark[m], start[m], (a.anchor - a.first)[m].astype(np.uint8), (width - LENGTH).astype(np.uint8), around)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in out], pa.int32()), pa.array([0] * len(out), pa.int64()), pa.array([0] * len(out), pa.int64()), pa.array([p for _, p in out], pa.binary())], ["bucket", "doc_id", "mark", "payload"])

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Packed rows wait as they are; one bucket at a time is opened.
        held: dict[int, list[bytes]] = {}
        for batch in batches:
            bucket = batch.column(0).to_numpy()
            if len(done := np.flatnonzero(bucket < 0)):
                yield batch.take(pa.array(done))
            for k in np.flatnonzero(bucket >= 0).tolist():
                held.setdefault(int(bucket[k]), []).append(batch.column(3)[k].as_py())
        while held:
            _, own = held.popitem()
            yield from _rank(*(np.concatenate(x) for x in zip(*(_unpack(p, *_MEMBER) for p in own), strict=True)))

    packed = map_batches(_input(docs), give, _ROW)
    # Ranges that are settled go to any task; packed anchors go by their grams.
    dealt = packed.repartition(parts, F.when(F.col("bucket") < 0, F.xxhash64("doc_id")).otherwise(F.col("bucket").cast("long")))
    return dealt.mapInArrow(rank, _ROW).select("doc_id", "mark", "payload")


def _slices(width: np.ndarray) -> Iterator[slice]:
    """Slices of rows of up to PIECE bytes together, or one row."""
    ends, low = np.cumsum(width), 0
    while low < len(width):
        high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + PIECE, side="right")))
        yield slice(low, high)
        low = high


def _rank(gram: np.ndarray, doc: np.ndarray, mark: np.ndarray, start: np.ndarray, offset: np.ndarray, extra: np.ndarray, data: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rounds 2 and 3 among anchors that include all of each gram. extra: windows less one; data: their bytes, end to end."""
    width = extra.astype(np.int64) + LENGTH
    ends = np.cumsum(width)
    begins = ends - width
    shape = np.zeros(len(gram), np.uint64)
    for own in _slices(width):
        base = begins[own][0]
        sums = _sums(data[base : ends[own][-1]])
        shape[own] = _mixed(_fingerprint(sums, begins[own] - base, ends[own] - base) + offset[own].astype(np.uint64))
    order = np.lexsort((start, doc, shape, gram))
    lead = np.append(True, (gram[order][1:] != gram[order][:-1]) | (shape[order][1:] != shape[order][:-1]))
    best = order[np.maximum.accumulate(np.where(lead, np.arange(len(order)), 0))]
    later = order[(doc[order] != doc[best]) | (start[order] != start[best])]
    if (rows := _run_rows(doc[later], mark[later], start[later], start[later] + width[later])) is not None:
        yield rows
    # Firsts of their shape, also those equally early, whose gram has other shapes too.
    firsts = order[(doc[order] == doc[best]) & (start[order] == start[best])]
    lead_gram = gram[order[lead]]
    several = np.unique(lead_gram[1:][lead_gram[1:] == lead_gram[:-1]])
    firsts = np.sort(firsts[np.isin(gram[firsts], several)])
    if not len(firsts):
        return
    n = extra[firsts].astype(np.int64) + 1
    windows = []
    for part in _slices(width[firsts]):
        m, size = firsts[part], width[firsts[part]]
        at = np.cumsum(size) - size
        inside = np.arange(int(size.sum())) - np.repeat(at, size)
        sums = _sums(data[np.repeat(begins[m], size) + inside])
        at = np.repeat(at, n[part]) + np.arange(int(n[part].sum())) - np.repeat(np.cumsum(n[part]) - n[part], n[part])
        windows.append(_fingerprint(sums, at, at + LENGTH))
    own = np.repeat(firsts, n)
    step = np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n)
    window, place = np.concatenate(windows), start[own] + step
    # The offset of the anchor in the window: counted from the anchor, windows of any surroundings compare.
    key = _mixed(window + gram[own] * _U(0x9E3779B97F4A7C15) + (offset[own].astype(np.int64) - step).astype(np.uint64))
    order = np.lexsort((place, doc[own], key))
    lead = np.append(True, key[order][1:] != key[order][:-1])
    best = order[np.maximum.accumulate(np.where(lead, np.arange(len(order)), 0))]
    again = np.zeros(len(own), bool)
    again[order] = (doc[own][order] != doc[own][best]) | (place[order] != place[best])
    hit = np.flatnonzero(again)
    if len(hit):
        # Neighbouring windows of one anchor make one range.
        head = np.append(True, (hit[1:] != hit[:-1] + 1) | (own[hit[1:]] != own[hit[:-1]]))
        a, b = hit[head], np.append(hit[np.flatnonzero(head)[1:] - 1], hit[-1])
        yield _run_rows(doc[own[a]], mark[own[a]], place[a], place[b] + LENGTH)


def _hot_repeats(docs: DataFrame, tables: tuple[bytes, bytes]) -> DataFrame:
    """(doc_id, mark, payload) of repeated windows whose anchors' grams are hot, by Spark's own aggregation and join."""
    shared = docs.sparkSession.sparkContext.broadcast(tables[1])

    def give(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot_table = _opened(shared.value)
        for a, ids, marks in _pieces(batches):
            m = np.flatnonzero(_in_table(hot_table, a.gram))
            n = (a.last - a.first)[m] + 1
            own = np.repeat(m, n)
            if not len(own):
                continue
            step = np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n)
            window = _fingerprint(a.sums, a.first[own] + step, a.first[own] + step + LENGTH)
            offset = (a.anchor - a.first)[own] - step
            row = a.row_of[a.piece[own]]
            values = (_mixed(a.gram[own] + offset.astype(np.uint64)).view(np.int64), window.view(np.int64), ids[row], marks[row], a.starts()[own] + step)
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in values], ["gram", "window", "doc_id", "mark", "place"])

    # Read twice below, so written once.
    windows = settled(map_batches(_input(docs), give, "gram long, window long, doc_id long, mark long, place long"))
    first = windows.groupBy("gram", "window").agg(F.min(F.struct("doc_id", "place")).alias("first"))
    later = windows.join(first, ["gram", "window"]).where(F.struct("doc_id", "place") != F.col("first"))
    spans = later.groupBy("doc_id", "mark").agg(F.sort_array(F.collect_list("place")).alias("places"))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs = []
            for k in range(batch.num_rows):
                p = batch.column(2)[k].values.to_numpy()
                runs.append(np.stack([p, p + LENGTH], 1).astype("<i8").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(runs, pa.binary())], ["doc_id", "mark", "payload"])

    return spans.mapInArrow(join, "doc_id long, mark long, payload binary")


def merged(runs: np.ndarray) -> np.ndarray:
    """Ranges (start, stop) as maximal ranges in order; ranges that touch are one."""
    runs = runs[np.argsort(runs[:, 0], kind="stable")]
    reach = np.maximum.accumulate(runs[:, 1])
    new = np.append(True, runs[1:, 0] > reach[:-1])
    at = np.flatnonzero(new)
    return np.stack([runs[at, 0], reach[np.append(at[1:], len(runs)) - 1]], 1)


def repeated_ranges(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """(doc_id, mark, payload): for each document with repeats, byte ranges to remove, unmerged. mark: xxhash64 of the text."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(size / SHARE))
    grams = _repeated_grams(docs, parts, hot).persist()
    tables = _bit_tables(grams)
    any_hot = not grams.where("hot").isEmpty()
    grams.unpersist()
    found = _repeats(docs, tables, parts)
    if any_hot:
        found = found.unionByName(_hot_repeats(docs, tables))
    return found


def removed(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """(doc_id, kept, n_bytes, spans) for each row of docs: the bytes that stay, and the removed ranges."""
    found = repeated_ranges(docs, hot).groupBy("doc_id", "mark").agg(F.collect_list("payload").alias("payload")).withColumnsRenamed({"doc_id": "d", "mark": "m"})
    rows = _input(docs)
    joined = rows.join(found, (F.coalesce("doc_id", F.lit(FIRST)) == F.col("d")) & (F.col("mark") == F.col("m")), "left").select("doc_id", "text", "payload")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flat_bytes(batch)
            kept, spans = [], []
            for k, runs in enumerate(column_of(batch, "payload").to_pylist()):
                text = data[offsets[k] : offsets[k + 1]]
                if runs:
                    cut = merged(np.frombuffer(b"".join(runs), "<i8").reshape(-1, 2))
                    keep = np.ones(len(text), bool)
                    for a, b in cut.tolist():
                        keep[a:b] = False
                    kept.append(text[keep].tobytes())
                    spans.append([{"start": a, "end": b} for a, b in cut.tolist()])
                else:
                    kept.append(text.tobytes())
                    spans.append([])
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([column_of(batch, "doc_id"), pa.array(kept, pa.binary()), pa.array(np.diff(offsets)), pa.array(spans, kind)], ["doc_id", "kept", "n_bytes", "spans"])

    return map_batches(joined, run, "doc_id long, kept binary, n_bytes long, spans array<struct<start:long,end:long>>")


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = removed(table(spark, sf_dir, "documents"))
    n_removed = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["start"])
    return out.select("doc_id", "n_bytes", n_removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {"op3_suffix_dedup": op3_suffix_dedup}
ORACLES: dict[str, str] = {}
