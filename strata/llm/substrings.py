"""Substring dedup by fixed-block anchors.

Every document is cut into non-overlapping reference blocks of ``window // 2 + 1`` words, counted
from its start, and every rolling run of as many words probes the index of those blocks: whatever
two windows of ``window`` words have in common, the first one holds a whole reference block and
the second one meets it. A run that a block and another place share is a hit. Hits are extended
to both sides, word for word, to every place a window around the hit can begin; a window that is
found again elsewhere is a repeat, and neighbouring repeats join into maximal exact repeats.

Nothing is paired. Documents are dealt into batches; a batch sends each distinct fingerprint of
its runs once to the bucket of the fingerprint (copies of a passage inside a batch meet there
already), the bucket matches blocks with probes and answers each batch with its hits. Windows
around hits then go the same way with 64 bits below the bucket: two different windows of a corpus
of 10^13 are taken for equal with a probability of about one in ten. Texts are shuffled once, by
batch; the three passes read that exchange again.

Defined cases: null, empty and short texts (fewer words than a window) have no repeats; a text
that repeats itself loses both passages; rows that repeat as a whole are copies of each other and
lose all their windows; ids may be null or repeat (a row in gives a row out); further columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import text_or_empty
from strata.llm.words import mix
from strata.llm.runs import (arrays, batch_counts, batch_number, cuts, keyed, members, received, rolling,
                             split_words, text_slices)

SPACES = b" \t\n\x0b\x0c\r"
WINDOW = 35
_OTHER_BASE = np.uint64(0xA0761D6478BD642F)

PROBES = "batch bigint, bucket bigint, prints binary, blocks binary, again binary"
HITS = "batch bigint, bucket bigint, prints binary"
WINDOWS = "batch bigint, bucket bigint, prints binary, again binary"


def _table(schema: str, **columns) -> pa.Table:
    kinds = {"bigint": pa.int64(), "binary": pa.binary(), "string": pa.string(), "array<bigint>": pa.list_(pa.int64())}
    fields = [pa.field(name, kinds[kind]) for name, kind in (c.split(" ") for c in schema.split(", "))]
    return pa.table([pa.array(columns.get(f.name, []), f.type) for f in fields], schema=pa.schema(fields))


class _Slice:
    """Words of some texts and the places where runs of words may begin."""

    def __init__(self, texts: list[str], window: int):
        self.words = split_words(texts, SPACES)
        bounds = self.words.bounds
        sizes = np.diff(bounds)
        self.begin = np.repeat(bounds[:-1], sizes)
        self.end = np.repeat(bounds[1:], sizes)
        self.long = self.end - self.begin >= window

    def prints(self, width: int, base=None) -> tuple[np.ndarray, np.ndarray]:
        """Places of the runs of ``width`` words that lie in one text, and their fingerprints."""
        prints = rolling(self.words.numbers, width) if base is None else rolling(self.words.numbers, width, base)
        at = np.flatnonzero((np.arange(len(prints)) + width <= self.end[:len(prints)]) & self.long[:len(prints)])
        return at, prints[at]


def _window_keys(part: _Slice, window: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places, buckets and fingerprints of all windows of a slice."""
    at, prints = part.prints(window)
    other = part.prints(window, _OTHER_BASE)[1]
    return at, ((other >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64), prints


def _homed(prints: np.ndarray, bucket) -> np.ndarray:
    """Fingerprint and bucket as one number."""
    return prints ^ mix(np.atleast_1d(np.asarray(bucket, np.uint64)) + np.uint64(1))


def _again(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values, and those that occur more than once."""
    values, n = np.unique(values, return_counts=True)
    return values, values[n > 1]


def _probe(window: int, buckets: int):
    width = window // 2 + 1

    def run(table: pa.Table) -> pa.Table:
        batch, probes, blocks = table.column("batch")[0].as_py(), [], []
        for _, texts in text_slices(table.column("text").to_pylist()):
            part = _Slice(texts, window)
            at, prints = part.prints(width)
            keys = keyed(prints, buckets)
            probes.append(keys)
            blocks.append(keys[(at - part.begin[at]) % width == 0])
        keys, again = _again(np.concatenate(probes))
        blocks = np.unique(np.concatenate(blocks))
        bounds = [cuts(k, buckets) for k in (keys, blocks, again)]
        used = np.flatnonzero(np.diff(bounds[0]))
        columns = [[values[c[b]:c[b + 1]].astype(np.uint32).tobytes() for b in used]
                   for values, c in zip((keys, blocks, again), bounds)]
        return _table(PROBES, batch=np.full(len(used), batch), bucket=used, prints=columns[0], blocks=columns[1],
                      again=columns[2])

    return run


def _match(table: pa.Table) -> pa.Table:
    """A bucket: fingerprints that are a reference block somewhere and begin in another place too."""
    parts = arrays(table.column("blocks"), np.uint32)
    blocks = np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.uint32)
    seen, met = np.zeros(len(blocks), np.int64), []
    for prints, again in zip(arrays(table.column("prints"), np.uint32), arrays(table.column("again"), np.uint32)):
        at = np.searchsorted(blocks, prints[members(prints, blocks)])
        seen[at] += 1
        seen[np.searchsorted(blocks, again[members(again, blocks)])] += 1
        met.append(at)
    hit = seen > 1
    out = [blocks[at[hit[at]]] for at in met]
    rows = [i for i, o in enumerate(out) if len(o)]
    batch, bucket = table.column("batch").to_numpy(), table.column("bucket").to_numpy()
    return _table(HITS, batch=batch[rows], bucket=bucket[rows], prints=[out[i].tobytes() for i in rows])


def _extend(window: int, buckets: int):
    width = window // 2 + 1

    def run(docs: pa.Table, hits: pa.Table) -> pa.Table:
        """Every window that holds a hit, one for each place it can begin at."""
        if not hits.num_rows or not docs.num_rows:
            return _table(WINDOWS)
        wanted, homes, prints = received(hits), [], []
        for _, texts in text_slices(docs.column("text").to_pylist()):
            part = _Slice(texts, window)
            at, runs = part.prints(width)
            hit = np.zeros(len(part.words.numbers) + 1, np.int64)
            hit[at[members(keyed(runs, buckets), wanted)] + 1] = 1
            upto = np.cumsum(hit)
            at, home, values = _window_keys(part, window, buckets)
            near = upto[at + window - width + 1] > upto[at]
            homes.append(home[near])
            prints.append(values[near])
        home, values = np.concatenate(homes), np.concatenate(prints)
        order = np.lexsort((values, home))
        home, values = home[order], values[order]
        new = np.ones(len(values), bool)
        new[1:] = (home[1:] != home[:-1]) | (values[1:] != values[:-1])
        first = np.flatnonzero(new)
        twice = first[np.diff(np.append(first, len(values))) > 1]
        places = np.arange(buckets + 1)
        bounds = [np.searchsorted(home[i], places) for i in (first, twice)]
        used = np.flatnonzero(np.diff(bounds[0]))
        batch = docs.column("batch")[0].as_py()
        columns = [[values[i][c[b]:c[b + 1]].tobytes() for b in used] for i, c in zip((first, twice), bounds)]
        return _table(WINDOWS, batch=np.full(len(used), batch), bucket=used, prints=columns[0], again=columns[1])

    return run


def _repeated(table: pa.Table) -> pa.Table:
    """A bucket of windows: those that begin in more than one place."""
    prints, again = (arrays(table.column(c), np.uint64) for c in ("prints", "again"))
    twice = _again(np.concatenate(prints + again))[1]
    out = [p[members(p, twice)] for p in prints]
    rows = [i for i, o in enumerate(out) if len(o)]
    batch, bucket = table.column("batch").to_numpy(), table.column("bucket").to_numpy()
    return _table(HITS, batch=batch[rows], bucket=bucket[rows], prints=[out[i].tobytes() for i in rows])


def _cover(window: int, buckets: int, schema: str, keep_text: bool):
    def run(docs: pa.Table, repeats: pa.Table) -> pa.Table:
        wanted = np.unique(np.concatenate([np.zeros(0, np.uint64), *(
            _homed(prints, bucket) for bucket, prints in
            zip(repeats.column("bucket").to_numpy(), arrays(repeats.column("prints"), np.uint64)))]))
        out: dict[str, list] = {"n_words": [], "n_removed": [], "starts": [], "ends": [], "kept_sha256": [],
                                "kept": []}
        for _, texts in text_slices(docs.column("text").to_pylist()):
            part = _Slice(texts, window)
            n = len(part.words.numbers)
            change = np.zeros(n + 1, np.int64)
            if len(wanted):
                at, home, prints = _window_keys(part, window, buckets)
                at = at[members(_homed(prints, home), wanted)]
                np.add.at(change, at, 1)
                np.add.at(change, at + window, -1)
            gone = np.cumsum(change)[:n] > 0
            for i, text in enumerate(texts):
                a, b = part.words.bounds[i], part.words.bounds[i + 1]
                mine = gone[a:b]
                words = text.encode().split()
                removed = int(mine.sum())
                edge = np.flatnonzero(np.diff(np.concatenate([[0], mine.astype(np.int8), [0]]))) if removed else \
                    np.zeros(0, np.int64)
                kept = b" ".join(compress(words, (~mine).tolist()) if removed else words)
                out["n_words"].append(int(b - a))
                out["n_removed"].append(removed)
                out["starts"].append(edge[0::2])
                out["ends"].append(edge[1::2])
                out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                out["kept"].append(kept.decode() if keep_text else None)
        return _table(schema, doc_id=docs.column("doc_id").combine_chunks(), **out)

    return run


def repeats(docs: DataFrame, window: int = WINDOW, keep_text: bool = False) -> DataFrame:
    """``docs(doc_id, text, …)`` → one row per document: ``doc_id, n_words, n_removed``, the maximal
    repeats as word places ``[starts[i], ends[i])``, ``kept_sha256`` of the words that stay joined
    by one space, and with ``keep_text`` that text as ``kept``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    batches, buckets = batch_counts(rows)
    rows = rows.select("doc_id", "text", batch_number(batches, "doc_id", "text"))
    probes = rows.groupBy("batch").applyInArrow(_probe(window, buckets), PROBES)
    hits = probes.groupBy("bucket").applyInArrow(_match, HITS)
    windows = rows.groupBy("batch").cogroup(hits.groupBy("batch")).applyInArrow(_extend(window, buckets), WINDOWS)
    again = windows.groupBy("bucket").applyInArrow(_repeated, HITS)
    schema = ("doc_id bigint, n_words bigint, n_removed bigint, starts array<bigint>, ends array<bigint>, "
              "kept_sha256 string" + (", kept string" if keep_text else ""))
    return rows.groupBy("batch").cogroup(again.groupBy("batch")).applyInArrow(
        _cover(window, buckets, schema, keep_text), schema)
