"""Cross-tokenizer alignment of a byte-level BPE (A) and a SentencePiece model (B).

Both tokenizers cover the same bytes, a space and the text. Where an A token and a B token end at
the same byte there is a shared cut, and the tokens between two neighbouring cuts are a group. Cuts
are found by divide and conquer: a common end near the middle of an interval is located by
bisecting the other side's ends, both halves are cut in turn, and an interval without a common end
is a leaf, a group. Every cut links the A token and the B token that end there; how often an id
pair is linked in the corpus tells how good a link is.

Texts are cut before blanks that follow a non-space first: A's pattern has no match across such a
place and B no piece with a blank inside (checked when the model is loaded; a model that has one
gets whole texts), so both tokenizers cut there too, and a chunk that occurs often is encoded and
aligned once. A task writes down a batch of documents at a time: the batch's chunks, its distinct
links with their counts, and every document as chunk numbers. The links are counted by shuffle, and
each batch gets back the corpus count of its own links. Texts are read once and never shuffled. A
batch is several rows, its parts: what an executor holds of a shuffle are small rows, in row groups
of a few of them, not one row of the size of a batch.

Defined cases: a null or empty text, and one whose tokens of A or B do not spell a space and the
text (a literal U+2581, say), has no tokens: counts 0 and the digest ''. Strings of special tokens
are plain text. Ids may be null or repeat, repeated rows count each; an empty table gives no
rows; further columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator
from itertools import chain, compress

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.bpe import byte_characters
from strata.llm.common import release_memory, stage, text_or_empty

BATCH_CHARS = 1 << 23
# Bytes of a part of a batch, about, and of a row group of the staged parts (100 rows at least).
PART_BYTES, GROUP_BYTES = 1 << 17, 1 << 23
# Chunks a worker remembers: at most this long, and so many characters of them.
REMEMBERED_LENGTH, REMEMBERED_CHARS = 64, 2_000_000
_CUT = re.compile(r"(?<=\S)(?= .)", re.DOTALL)
_IRREGULAR = re.compile(r"\s |^ | $")
_SHIFT = 32

BATCH = ("batch bigint, part bigint, doc_ids array<bigint>, n_a array<bigint>, n_b array<bigint>, "
         "n_groups array<bigint>, shas array<string>, groups array<string>, chunks binary, sizes array<bigint>, "
         "links binary, link_sizes binary, pair_from bigint, pairs array<bigint>, counts array<bigint>")
RESULT = ("doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, "
          "groups_sha256 string")
_KINDS = {"bigint": pa.int64(), "binary": pa.binary(), "string": pa.string(), "array<bigint>": pa.list_(pa.int64()),
          "array<string>": pa.list_(pa.string())}


def _batch(schema: str, columns: dict) -> pa.RecordBatch:
    fields = [pa.field(name, _KINDS[kind]) for name, kind in (c.split(" ") for c in schema.split(", "))]
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in fields], schema=pa.schema(fields))


def _packed(numbers: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(numbers.tobytes())


def _unpacked(column: pa.ChunkedArray) -> np.ndarray:
    """The numbers of all rows, in their order."""
    unpack = zstandard.ZstdDecompressor().decompress
    return np.concatenate([np.zeros(0, np.uint32), *(np.frombuffer(unpack(b.as_buffer()), np.uint32)
                                                     for b in column)])


def chunks(text: str) -> list[str]:
    """The text cut before blanks that follow a non-space and precede anything; all chunks but the
    first lack the blank they begin with."""
    if not _IRREGULAR.search(text):
        return text.split(" ")
    first, *rest = _CUT.split(text)
    return [first, *(c[1:] for c in rest)]


def shared_cuts(a_ends: np.ndarray, b_ends: np.ndarray, leaf: int = 4096) -> tuple[np.ndarray, np.ndarray]:
    """Places in A and in B of the ends that both have, in order. Ends ascend and the last ones are
    equal.

    An interval is cut at the common end nearest to its middle, found by bisecting B's ends around
    there, and both halves are cut in turn; in one of ``leaf`` tokens or fewer all ends are bisected
    at once, and one without a common end inside is a group."""
    found, open_intervals = [], [(0, len(a_ends), 0, len(b_ends))]
    while open_intervals:
        a, a_to, b, b_to = open_intervals.pop()
        if a_to - a <= max(leaf, 1):
            found.append(_bisected(a_ends, b_ends, a, a_to, b, b_to))
            continue
        middle, reach = (a + a_to - 1) // 2, 16
        while True:
            near, at = _bisected(a_ends, b_ends, max(a, middle - reach), min(a_to - 1, middle + reach + 1), b, b_to)
            if len(near):
                k = int(np.argmin(np.abs(near - middle)))
                cut = int(near[k]) + 1, int(at[k]) + 1
                open_intervals += [(cut[0], a_to, cut[1], b_to), (a, cut[0], b, cut[1])]
                break
            if reach >= a_to - a:
                found.append((np.array([a_to - 1]), np.array([b_to - 1])))
                break
            reach *= 8
    return tuple(np.concatenate([np.zeros(0, np.int64), *(f[side] for f in found)]) for side in (0, 1))


def _bisected(a_ends, b_ends, a, a_to, b, b_to) -> tuple[np.ndarray, np.ndarray]:
    """The ends of A from ``a`` to ``a_to`` that are ends of B from ``b`` to ``b_to`` too: places in both."""
    at = np.searchsorted(b_ends[b:b_to], a_ends[a:a_to])
    hit = np.flatnonzero(at < b_to - b)
    hit = hit[b_ends[b + at[hit]] == a_ends[a + hit]]
    return a + hit, b + at[hit]


def cut_groups(a_ends: list[int], b_ends: list[int], leaf: int = 4096) -> list[tuple[int, int, int, int]]:
    """Token ranges ``(a_from, a_to, b_from, b_to)`` of the groups, in order."""
    a, b = shared_cuts(np.array(a_ends), np.array(b_ends), leaf)
    a, b = (a + 1).tolist(), (b + 1).tolist()
    return list(zip([0, *a[:-1]], a, [0, *b[:-1]], b))


class Aligner:
    """The two tokenizers of a worker process and the chunks it met lately."""

    def __init__(self, path_a: str, path_b: str):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker per core
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        to_byte = byte_characters()
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(vocabulary.values(), default=-1) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = bytes(to_byte[c] for c in token) if all(c in to_byte for c in token) else token.encode()
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else
                        b"\xff" if self.b.is_control(i) or self.b.is_unknown(i) else  # spells no text
                        p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.a_sizes, self.b_sizes = (np.array([len(p) for p in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        # How a token is written inside a group and at its end: A's, then B's.
        self.spelling = [f"{i}{end}" for table, ends in ((self.a_bytes, ",|"), (self.b_bytes, ",;"))
                         for i in range(len(table)) for end in ends]
        self.by_chunk = not any(re.search("[^▁]▁", p) for p in pieces)
        self.known: dict[str, tuple | None] = {}
        self.held = 0

    def _align(self, chunks: list[str], a: list[list[int]], b: list[list[int]]) -> list[tuple | None]:
        """``(n_a, n_b, n_groups, groups as text, links)`` of chunks; None where the tokens spell something
        else. All chunks are one sequence of bytes here: where a chunk ends there is a shared cut."""
        n_a, n_b = (np.fromiter(map(len, x), np.int64, len(x)) for x in (a, b))
        spelled = [(" " + c).encode() for c in chunks]
        sizes = np.fromiter(map(len, spelled), np.int64, len(spelled))
        a_ids, b_ids = (np.fromiter(chain.from_iterable(x), np.int64, int(n.sum())) for x, n in ((a, n_a), (b, n_b)))
        good = np.ones(len(chunks), bool)
        for ids, n, lengths in ((a_ids, n_a, self.a_sizes), (b_ids, n_b, self.b_sizes)):
            upto = np.concatenate([[0], np.cumsum(lengths[ids])])
            ends = np.cumsum(n)
            good &= upto[ends] - upto[ends - n] == sizes
        if good.all():
            whole = np.frombuffer(b"".join(spelled), np.uint8)
            for ids, table in ((a_ids, self.a_bytes), (b_ids, self.b_bytes)):
                own = np.frombuffer(b"".join(map(table.__getitem__, ids.tolist())), np.uint8)
                good[np.searchsorted(np.cumsum(sizes), np.flatnonzero(own != whole), side="right")] = False
        if not good.all():
            rest = iter(self._align(*(list(compress(x, good)) for x in (chunks, a, b))) if good.any() else ())
            return [next(rest) if g else None for g in good.tolist()]
        a_ends, b_ends = np.cumsum(self.a_sizes[a_ids]), np.cumsum(self.b_sizes[b_ids])
        a_cuts, b_cuts = shared_cuts(a_ends, b_ends)
        links = ((a_ids[a_cuts] << _SHIFT) | b_ids[b_cuts]).tobytes()
        cuts = np.concatenate([[0], np.searchsorted(a_ends[a_cuts], np.cumsum(sizes), side="right")])
        # The tokens in the order of the text: A's of a group, B's of it, A's of the next one, ...
        at_a, at_b = np.arange(len(a_ids)), np.arange(len(b_ids))
        a_place = at_a + np.concatenate([[0], b_cuts + 1])[np.searchsorted(a_cuts, at_a)]
        b_place = at_b + a_cuts[np.searchsorted(b_cuts, at_b)] + 1
        written = np.empty(len(a_ids) + len(b_ids), np.int64)
        written[a_place], written[b_place] = 2 * a_ids, 2 * (len(self.a_bytes) + b_ids)
        written[a_place[a_cuts]] += 1
        written[b_place[b_cuts]] += 1
        words = list(map(self.spelling.__getitem__, written.tolist()))
        ends = np.cumsum(n_a + n_b).tolist()
        texts = ["".join(words[i:j]) for i, j in zip([0, *ends[:-1]], ends)]
        cuts = cuts.tolist()
        return list(zip(n_a.tolist(), n_b.tolist(), [j - i for i, j in zip(cuts[:-1], cuts[1:])], texts,
                        [links[8 * i:8 * j] for i, j in zip(cuts[:-1], cuts[1:])]))

    def learn(self, wanted: set[str]) -> dict[str, tuple | None]:
        """The alignments of chunks."""
        found = {c: self.known[c] for c in wanted if c in self.known}
        new = list(wanted - found.keys())
        if new:
            a = [e.ids for e in self.a.encode_batch_fast([" " + c for c in new], add_special_tokens=False)]
            found.update(zip(new, self._align(new, a, self.b.encode(new, num_threads=1))))
        if self.held > REMEMBERED_CHARS:
            self.known, self.held = {}, 0
        for c in new:
            if len(c) <= REMEMBERED_LENGTH:
                self.known[c] = found[c]
                self.held += len(c) + 8
        return found

    def cut(self, text: str) -> list[str]:
        return chunks(text) if self.by_chunk else [text]


@functools.lru_cache(maxsize=1)
def _worker(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


class _Batch:
    """Documents of a task up to some size, as numbers of the chunks they hold."""

    def __init__(self, aligner: Aligner, keep_groups: bool):
        self.aligner, self.keep_groups = aligner, keep_groups
        self.number: dict[str, int] = {}
        self.rows: list[tuple] = []
        self.texts: list[str] = []  # the groups of each chunk, each with ";" at its end
        self.bad: set[int] = set()
        self.ids, self.shas, self.groups, self.codes, self.chars = [], [], [], [], 0

    def add(self, ids: list, texts: list[str]):
        cut = [self.aligner.cut(t) if t else [] for t in texts]
        new = set().union(*cut) - self.number.keys()
        found = self.aligner.learn(new)
        for c in new:
            self.number[c] = len(self.rows)
            if found[c] is None:
                self.bad.add(len(self.rows))
            self.rows.append(found[c] or (0, 0, 0, "", b""))
            self.texts.append(self.rows[-1][3])
        for parts in cut:
            codes = list(map(self.number.__getitem__, parts))
            if not parts or not self.bad.isdisjoint(codes):
                codes, sha, text = [], "", ""
            else:
                text = "".join(map(self.texts.__getitem__, codes))[:-1]
                sha = hashlib.sha256(text.encode()).hexdigest()
            self.codes.append(np.array(codes, np.uint32))
            self.shas.append(sha)
            self.groups.append(text if self.keep_groups else None)
        self.ids += ids
        self.chars += sum(map(len, texts))

    def parts(self, batch: int) -> Iterator[pa.RecordBatch]:
        """The batch in rows of about ``PART_BYTES`` before they are packed. Each of its lists is cut evenly,
        a document's chunks too; joined in the order of ``part`` they are whole."""
        rows = self.rows
        codes = np.concatenate([np.zeros(0, np.uint32), *self.codes])
        bounds = np.concatenate([[0], np.cumsum([len(c) for c in self.codes])])
        link_sizes = np.array([len(r[4]) // 8 for r in rows], np.int64)
        links = np.frombuffer(b"".join([r[4] for r in rows]), np.int64)
        pairs, of = np.unique(links, return_inverse=True)
        times = np.bincount(codes, minlength=len(rows))  # of each chunk
        n = np.bincount(of, weights=np.repeat(times, link_sizes), minlength=len(pairs)).astype(np.int64)

        def per_document(k: int) -> np.ndarray:
            upto = np.concatenate([[0], np.cumsum(np.array([r[k] for r in rows], np.int64)[codes])])
            return upto[bounds[1:]] - upto[bounds[:-1]]

        lists = {
            "doc_ids": self.ids, "n_a": per_document(0), "n_b": per_document(1), "n_groups": per_document(2),
            "shas": self.shas, "groups": self.groups, "chunks": codes, "sizes": np.diff(bounds),
            "links": of.astype(np.uint32), "link_sizes": link_sizes.astype(np.uint32), "pairs": pairs, "counts": n}
        size = (104 * len(self.ids) + sum(len(g or "") for g in self.groups) + 16 * len(pairs)
                + 4 * (len(codes) + len(links) + len(link_sizes)))
        parts = max(1, -(-size // PART_BYTES))
        for k in range(parts):
            cut = {c: v[len(v) * k // parts:len(v) * (k + 1) // parts] for c, v in lists.items()}
            cut |= {c: _packed(cut[c]) for c in ("chunks", "links", "link_sizes")}
            yield _batch(BATCH, {"batch": [batch], "part": [k], "pair_from": [len(pairs) * k // parts]}
                         | {c: [v] for c, v in cut.items()})


def encoded(docs: DataFrame, path_a: str, path_b: str, keep_groups: bool = False) -> DataFrame:
    """The parts of each batch of documents: their ids and token counts, the digest of their groups, and
    what it takes to add up their links (see ``BATCH``)."""
    def run(batches):
        aligner = _worker(path_a, path_b)
        task, made, held = TaskContext.get().partitionId(), 0, None
        for arrow in batches:
            for at in range(0, arrow.num_rows, 128):
                part = arrow.slice(at, 128)
                held = held or _Batch(aligner, keep_groups)
                held.add(part.column("doc_id").to_pylist(), part.column("text").to_pylist())
                if held.chars >= BATCH_CHARS:
                    yield from held.parts(task << 32 | made)
                    made, held = made + 1, None
        if held:
            yield from held.parts(task << 32 | made)
            held = None
            release_memory()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(run, BATCH)


def pair_counts(batches: DataFrame) -> DataFrame:
    """``pair, n, best``: how many links of the corpus hold an id pair (``a << 32 | b``), and the
    highest such count of its B id."""
    each = batches.select(F.explode(F.arrays_zip("pairs", "counts")).alias("p")).select("p.pairs", "p.counts")
    totals = each.groupBy(F.col("pairs").alias("pair")).agg(F.sum("counts").alias("n")).where("n > 0")
    totals = stage(totals.withColumn("b", F.col("pair").bitwiseAND(F.lit((1 << _SHIFT) - 1))), "alignment-pairs")
    best = totals.groupBy(F.col("b").alias("of")).agg(F.max("n").alias("best"))
    return totals.join(best, F.col("b") == F.col("of")).select("pair", "n", "best")


def align(docs: DataFrame, path_a: str, path_b: str, keep_groups: bool = False) -> DataFrame:
    """``docs(doc_id, text, …)`` → one row per document: ``doc_id, n_a, n_b, n_groups, n_links, n_best,
    count_sum, groups_sha256``, and with ``keep_groups`` the groups themselves as text
    (``a1,a2|b1;a3|b2,b3``)."""
    batches = stage(encoded(docs, path_a, path_b, keep_groups), "alignment-batches",
                    **{"parquet.block.size": str(GROUP_BYTES)})
    pairs = pair_counts(batches)
    mine = batches.select("batch", "pair_from", F.posexplode("pairs").alias("at", "own"))
    answers = mine.join(pairs, F.col("own") == F.col("pair")).select(
        F.col("batch").alias("to_batch"), (F.col("pair_from") + F.col("at")).alias("pos"), "n",
        (F.col("n") == F.col("best")).alias("is_best"))
    schema = RESULT + (", groups string" if keep_groups else "")

    def add_up(left: pa.Table, right: pa.Table) -> pa.Table:
        _worker.cache_clear()  # a worker that encoded before needs its tokenizers no more
        left = left.sort_by("part")
        codes, links, link_sizes = (_unpacked(left.column(c)) for c in ("chunks", "links", "link_sizes"))
        flat = {c: left.column(c).combine_chunks().flatten() for c in
                ("doc_ids", "n_a", "n_b", "n_groups", "shas", "groups", "sizes")}
        pos = right.column("pos").to_numpy()
        size = int(max(pos.max(initial=-1), links.max(initial=0))) + 1
        n, best = np.zeros(size, np.int64), np.zeros(size, np.int64)
        n[pos] = right.column("n").to_numpy()
        best[pos] = right.column("is_best").combine_chunks().cast(pa.int64()).to_numpy(zero_copy_only=False)
        bounds = np.concatenate([[0], np.cumsum(flat["sizes"].to_numpy())])
        at = np.concatenate([[0], np.cumsum(link_sizes, dtype=np.int64)])

        def per_document(values):
            upto = np.concatenate([[0], np.cumsum(values[links])])
            upto = np.concatenate([[0], np.cumsum((upto[at[1:]] - upto[at[:-1]])[codes])])
            return upto[bounds[1:]] - upto[bounds[:-1]]

        columns = {c: flat[c] for c in ("n_a", "n_b", "n_groups", "groups")} | {
            "doc_id": flat["doc_ids"], "groups_sha256": flat["shas"],
            "n_links": per_document(np.ones(size, np.int64)), "n_best": per_document(best),
            "count_sum": per_document(n)}
        made = pa.Table.from_batches([_batch(schema, columns)])
        del codes, links, link_sizes, n, best, at, left, right
        release_memory()
        return made

    return batches.drop("pair_from", "pairs", "counts").groupBy("batch").cogroup(
        answers.groupBy("to_batch")).applyInArrow(add_up, schema)
