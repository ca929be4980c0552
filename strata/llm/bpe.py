"""Byte-level BPE encoding and decoding over Arrow batches.

The vocabulary file of the tokenizers library is a parameter (a path every executor can open).
Byte-level BPE writes each byte as one printable character; token strings are turned back by the
inverse of that mapping and joined as bytes before UTF-8 decoding, so characters split over two
tokens survive. Texts are cut before blanks that follow a non-space: no match of the splitting
pattern spans that place, so the ids are those of the whole text, and a chunk that repeats in a
batch or was met lately is encoded once.

Defined cases: a null or empty text has no ids; special-token strings in a text are ordinary
text; repeated rows are encoded each; an empty table gives no rows; other columns are carried
along (a column named like an output is replaced).
"""

from __future__ import annotations

import functools
import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import text_or_empty

REMEMBERED = 400_000  # chunks whose ids a worker keeps
_SPACE_RUN = re.compile(r"\s ")
_CUT = re.compile(r"(?<=\S)(?= )")


def byte_characters() -> dict[str, int]:
    """Character → byte: printable bytes of Latin-1 stand for themselves, the others take the
    characters from 256 on, in order."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def chunks(text: str) -> list[str]:
    """The text cut before every blank that follows a non-space. The first chunk is as it is,
    the others lack the blank they begin with."""
    if not _SPACE_RUN.search(text) and not text.startswith(" "):
        return text.split(" ")
    first, *rest = _CUT.split(text)
    return [first, *(c[1:] for c in rest)]


class ByteBPE:
    """One tokenizer of a worker process."""

    def __init__(self, path: str):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker per core
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        to_byte = byte_characters()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.table = [b""] * (max(vocabulary.values(), default=-1) + 1)
        for token, i in vocabulary.items():
            self.table[i] = bytes(to_byte[c] for c in token) if all(c in to_byte for c in token) else token.encode()

        self.first: dict[str, bytes] = {}
        self.later: dict[str, bytes] = {}

    def _learn(self, known: dict[str, bytes], new: set[str], prefix: str):
        if len(known) > REMEMBERED:
            known.clear()
        new = list(new - known.keys())
        made = self.tokenizer.encode_batch_fast([prefix + c for c in new], add_special_tokens=False)
        known.update((c, np.array(e.ids, "<u4").tobytes()) for c, e in zip(new, made))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text; chunks that repeat are encoded once."""
        cut = [chunks(t) for t in texts]
        self._learn(self.first, {c[0] for c in cut}, "")
        self._learn(self.later, {c for chunk in cut for c in chunk[1:]}, " ")
        return [np.frombuffer(self.first[c[0]] + b"".join(map(self.later.__getitem__, c[1:])), "<u4") for c in cut]

    def encode_with_offsets(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids and, for each token, the characters ``[start, end)`` of the text that hold its
        bytes (tokens that share a split character all point at it)."""
        ids = self.encode([text])[0]
        ends = np.cumsum([len(self.table[i]) for i in ids], dtype=np.int64)
        holder = np.repeat(np.arange(len(text)), [len(c.encode()) for c in text])  # byte → character
        spans = np.stack([holder[np.concatenate([[0], ends[:-1]])], holder[ends - 1] + 1], axis=1) if len(ids) \
            else np.zeros((0, 2), np.int64)
        return ids, spans

    def decode(self, ids) -> bytes:
        return b"".join(map(self.table.__getitem__, ids))

    def stream_decoder(self):
        """A function id → text that holds back the bytes of an unfinished character."""
        import codecs
        decoder = codecs.getincrementaldecoder("utf-8")("replace")
        return lambda i, final=False: decoder.decode(self.table[i] if i is not None else b"", final)


@functools.lru_cache(maxsize=2)
def _worker(path: str) -> ByteBPE:
    return ByteBPE(path)


def _in_slices(batches, rows: int = 256):
    """Arrow batches in slices, so that the Python objects of one slice at a time exist."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def encode(docs: DataFrame, path: str, offsets: bool = False) -> DataFrame:
    """``docs(text, …)`` with ``ids array<int>`` and ``n_tokens long`` in place of ``text``, and
    with ``offsets`` also ``starts`` and ``ends`` (array<int>, in characters)."""
    made = ("ids", "n_tokens", "starts", "ends")
    carried = [c for c in docs.columns if c not in ("text", *made)]
    schema = T.StructType([docs.schema[c] for c in carried])
    schema.add("ids", T.ArrayType(T.IntegerType())).add("n_tokens", T.LongType())
    if offsets:
        schema.add("starts", T.ArrayType(T.IntegerType())).add("ends", T.ArrayType(T.IntegerType()))

    def run(batches):
        bpe = None
        for batch in _in_slices(batches):
            bpe = bpe or _worker(path)
            texts = batch.column("_text").to_pylist()
            columns = [batch.column(f"_{i}") for i in range(len(carried))]
            if offsets:
                both = [bpe.encode_with_offsets(t) for t in texts]
                ids = [b[0] for b in both]
            else:
                ids = bpe.encode(texts)
            columns += [pa.array([i.astype(np.int32) for i in ids], pa.list_(pa.int32())),
                        pa.array([len(i) for i in ids], pa.int64())]
            if offsets:
                columns += [pa.array([b[1][:, k].astype(np.int32) for b in both], pa.list_(pa.int32()))
                            for k in (0, 1)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    numbered = docs.select(text_or_empty().alias("_text"),
                           *[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(carried)])
    return numbered.mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str, column: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded binary``, the bytes of its ids (null ids: no bytes)."""
    @F.udf(returnType=T.BinaryType(), useArrow=True)
    def to_bytes(ids):
        return _worker(path).decode(ids if ids is not None else ())
    return encoded.withColumn("decoded", to_bytes(F.col(column)))


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """Encode every text and decode the ids again, in one pass: ``doc_id, n_tokens, ids_sha256,
    decoded_sha256``."""
    def run(batches):
        bpe = None
        for batch in _in_slices(batches):
            bpe = bpe or _worker(path)
            out = []
            for ids in bpe.encode(batch.column("text").to_pylist()):
                out.append((len(ids), hashlib.sha256(ids.tobytes()).hexdigest(),
                            hashlib.sha256(bpe.decode(ids.tolist())).hexdigest()))
            n, ids_sha, decoded_sha = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids_sha), pa.array(decoded_sha)],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(
        run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
