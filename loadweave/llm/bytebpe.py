"""Byte-level BPE encoding and decoding through sentencepiece.

The rank file of a byte-level BPE vocabulary is serialised as a sentencepiece BPE model: each token's bytes are written as
printable characters (one per byte), a piece's score is its negative rank, and normalisation is the identity, so that
sentencepiece merges the same pairs in the same order as the rank file asks for. Decoding maps ids back to bytes.

A text is cut into stretches that start at a single space, where the split pattern always starts a token; stretches repeat
a lot, so each worker keeps the ids of those it has met in a table of bounded size. Texts with runs of white space around a
space, where that cut could differ, are split as a whole.

Cases: a null or empty text gives no ids and the digests of zero bytes; long texts are encoded whole; repeated rows give
repeated results; an empty table gives no rows; further columns are ignored by `encode_documents` and kept by `encode`.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import column_of, map_batches, table, texts_of, widened

#: Stretches whose ids a worker keeps in each of two generations.
CACHE_ENTRIES = 300_000
#: A user-defined piece, across which nothing merges; the ids of the vocabulary's tokens follow it.
SEPARATOR, SEPARATOR_ID, FIRST_ID = "\ue000", 1, 2
#: A white space, a space, then white space or the end: only there may a token run across the start of a stretch.
_RUN = re.compile(r"\s \s|\s \Z")


def byte_characters() -> list[str]:
    """A printable character for each byte: itself where it is printable Latin-1, else one from 256 up in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


def read_ranks(data: bytes) -> dict[bytes, int]:
    """The lines "base64 rank" of a rank file."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines()) if a}


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, value: bytes | str | int | float) -> bytes:
    """One field of a protocol-buffer message."""
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    value = value.encode() if isinstance(value, str) else value
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def serialise_model(ranks: dict[bytes, int]) -> bytes:
    """A sentencepiece model: piece 0 is unknown, piece 1 the separator, piece r + 2 the token of rank r. Ranks must be 0, 1, 2, ..."""
    tokens = sorted(ranks, key=ranks.__getitem__)
    if [ranks[t] for t in tokens] != list(range(len(tokens))):
        raise ValueError("ranks must be consecutive from 0")
    chars = byte_characters()
    pieces = [_field(1, _field(1, "<unk>") + _field(2, 0.0) + _field(3, 2)), _field(1, _field(1, SEPARATOR) + _field(2, 0.0) + _field(3, 4))]
    pieces += [_field(1, _field(1, "".join(chars[b] for b in t)) + _field(2, float(-r))) for r, t in enumerate(tokens)]
    bpe = 2
    trainer = _field(3, bpe) + _field(4, len(pieces)) + _field(40, 0) + b"".join(_field(n, 2**64 - 1) for n in (41, 42, 43))
    normalizer = _field(1, "identity") + _field(2, b"") + b"".join(_field(n, 0) for n in (3, 4, 5))
    return b"".join(pieces) + _field(2, trainer) + _field(3, normalizer)


class Codec:
    """Encodes and decodes with one vocabulary; made once in each worker."""

    def __init__(self, model: bytes, ranks: dict[bytes, int], pattern: str):
        import regex
        import sentencepiece

        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.split = regex.compile(pattern).findall
        self.tokens = sorted(ranks, key=ranks.__getitem__)
        # Pre-tokens are put end to end around a separator; its byte, FF, is in no UTF-8 text.
        self.characters = dict(enumerate(byte_characters())) | {0xFF: SEPARATOR}
        # By stretch, without the space that it starts with.
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        # A pre-token that is itself a token is that token, also if no merges lead to it.
        self.whole = self._not_reached(ranks)

    def _not_reached(self, ranks: dict[bytes, int]) -> dict[bytes, int]:
        tokens = [t for t in ranks if b"\xff" not in t]
        if not tokens:
            return {}
        ids, counts = self._merged(tokens)
        first = np.cumsum(counts) - counts
        return {t: ranks[t] for t, n, k in zip(tokens, counts.tolist(), first.tolist(), strict=True) if n != 1 or ids[k] != ranks[t]}

    def _merged(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all parts end to end, and how many each part has."""
        found, counts = [], []
        for k in range(0, len(parts), 4000):
            some = parts[k : k + 4000]
            ids = np.array(self.pieces.encode(b"\xff".join(some).decode("latin-1").translate(self.characters), out_type=int), np.int64)
            cuts = np.flatnonzero(ids == SEPARATOR_ID)
            found.append(ids[ids != SEPARATOR_ID] - FIRST_ID)
            counts.append(np.diff(cuts, prepend=-1, append=len(ids)) - 1)
        return np.concatenate(found), np.concatenate(counts)

    def _parts(self, stretch: str) -> list[str]:
        """The matches of the split pattern; the plainest stretches, a space and letters and maybe a full stop, need no pattern."""
        if stretch[:1] == " " and stretch[1:].isalpha():
            return [stretch]
        if stretch[:1] == " " and stretch[-1] in ".," and stretch[1:-1].isalpha():
            return [stretch[:-1], stretch[-1]]
        return self.split(stretch)

    def _learn(self, stretches: list[str]) -> list[bytes]:
        parts = [self._parts(s) for s in stretches]
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        flat = [p.encode() for ps in parts for p in ps]
        if not flat:
            return [b""] * len(stretches)
        ids, counts = self._merged(flat)
        if self.whole and (odd := [k for k, p in enumerate(flat) if p in self.whole]):
            pieces = np.split(ids, np.cumsum(counts)[:-1])
            for k in odd:
                pieces[k], counts[k] = np.array([self.whole[flat[k]]]), 1
            ids = np.concatenate(pieces)
        ends = np.concatenate([[0], np.cumsum(counts)])[np.cumsum(sizes)] * 4
        data, starts = ids.astype("<u4").tobytes(), [0, *ends.tolist()]
        return [data[a:b] for a, b in zip(starts, starts[1:])]

    def _look_up(self, stretches: list[str], before: str = "") -> bytes:
        """The ids of all stretches end to end, each after `before`."""
        known = self.known
        ids = list(map(known.get, stretches))
        if None in ids:
            old, new = self.old, []
            for s in {s for s, x in zip(stretches, ids, strict=True) if x is None}:
                if (x := old.get(s)) is None:
                    new.append(s)
                else:
                    known[s] = x
            if new:
                known.update(zip(new, self._learn([before + s for s in new]), strict=True))
            ids = map(known.__getitem__, stretches)
        return b"".join(ids)

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if _RUN.search(text):
            return b"".join(self._learn(self.split(text)))
        first, *rest = text.split(" ")
        ids = b"".join(self._learn([first])) + self._look_up(rest, " ") if first else self._look_up(rest, " ")
        if len(self.known) > CACHE_ENTRIES:
            self.known, self.old = {}, self.known
        return ids

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, memoryview(ids).cast("I")))


def vocabulary(path: str | None = None, pattern: str | None = None) -> tuple[bytes, str]:
    """The bytes of a rank file and the split pattern; the public 50k byte-level vocabulary unless told otherwise."""
    if path is None or pattern is None:
        import public_tokenizers

        path, pattern = path or public_tokenizers.path("byte_bpe_50k.tiktoken"), pattern or public_tokenizers.PATTERN
    with open(path, "rb") as f:
        return f.read(), pattern


def encode(docs: DataFrame, path: str | None = None, pattern: str | None = None, text: str = "text") -> DataFrame:
    """docs with `ids` (array of int), `ids_le` (the same as bytes) and `decoded` (the bytes that the ids stand for);
    columns of these names are replaced, all others kept."""
    spark = docs.sparkSession
    # The vocabulary file is read once, on the driver; its size does not depend on the data.
    rank_file, pattern = vocabulary(path, pattern)
    shared = spark.sparkContext.broadcast((rank_file, pattern))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared.value)
        for batch in batches:
            step = 200
            for k in range(0, batch.num_rows, step):
                part = batch.slice(k, step)
                ids = [codec.encode(t) for t in texts_of(part, text)]
                lists = pa.array([np.frombuffer(b, "<u4").astype(np.int32) for b in ids], pa.list_(pa.int32()))
                new = [lists, pa.array(ids, pa.binary()), pa.array(map(codec.decode, ids), pa.binary())]
                yield pa.RecordBatch.from_arrays([*part.columns, *new], [*part.schema.names, "ids", "ids_le", "decoded"])

    kept = docs.drop("ids", "ids_le", "decoded")
    return map_batches(kept, run, widened(kept, "ids array<int>, ids_le binary, decoded binary"))


_made: dict[int, Codec] = {}


def _codec(value: tuple[bytes, str]) -> Codec:
    key = hash(value)
    if key not in _made:
        _made.clear()
        ranks = read_ranks(value[0])
        _made[key] = Codec(serialise_model(ranks), ranks, value[1])
    return _made[key]


def encode_documents(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each whole text: `encode`, reduced to digests in the worker."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(vocabulary(path, pattern))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared.value)
        for batch in batches:
            n, a, b = [], [], []
            for t in texts_of(batch):
                ids = codec.encode(t)
                n.append(len(ids) // 4)
                a.append(hashlib.sha256(ids).hexdigest())
                b.append(hashlib.sha256(codec.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([column_of(batch, "doc_id"), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return map_batches(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"))


QUERIES = {"op4_byte_bpe": op4_byte_bpe}
ORACLES: dict[str, str] = {}
