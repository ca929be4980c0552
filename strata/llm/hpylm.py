"""Language-model scores by a hierarchical Pitman-Yor model.

Every word is drawn in the restaurant of its context, and the tables of all context restaurants
are the customers of one parent restaurant of single words, whose base is uniform over the
vocabulary and one unknown word. A context is the 64-bit number of the previous word, or the start
of a text: every word that precedes another has a restaurant of its own. Seatings are
sampled by blocked Gibbs sweeps: the customers of a dish leave and are seated again one after
another, given the table counts of the sweep before; the predictive probabilities of the sweeps
after the burn-in are averaged.

How it runs:

* One pass cuts the texts into blocks of documents and sends every block's (word, context,
  document, count) entries, sorted and compressed, to the buckets of the words. A bucket holds
  all that its words need: counts, tables, and their part of the parent restaurant. Words with a
  large share of all tokens (at most ``8 * buckets`` of them) are split over all buckets by
  context, and their parent counts travel with the totals, which are a few numbers per
  restaurant.
* The restaurants are kept as rows dealt by context to as many groups as there are buckets. A
  bucket tells each group what it holds of the group's contexts, the group adds up the buckets'
  parts and answers each bucket with the totals of its own contexts. Pairs (word, context) with
  one customer keep their one table, so a sweep exchanges only contexts of pairs with more.
* A sweep joins the answers to the buckets' seatings by shuffle. Only the totals of the parent
  restaurant (a few numbers and one row per hot word) reach the driver. Seatings and messages are
  written once per sweep, so a lost executor costs no more than its own tasks. On disk stay the
  buckets, the seatings of one sweep, and the messages until they are answered for the scoring;
  the shuffles of a step go when its rows are written.
* Scoring joins the totals of all sweeps to the buckets, replays the seatings (random numbers are
  seeded by bucket and sweep) and returns partial sums per document for one grouping by block. The
  number of buckets grows with the texts, so that a bucket stays small.

Defined cases: a null or empty text is one end token; rows whose id is null are learned from;
repeated rows count as often as they occur; without training rows every token is unknown; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import (discard_part, release_memory, shuffles_freed, stage, stage_parts,
                               text_or_empty)
from strata.llm.words import in_slices, mix, word_numbers

CONTEXTS = 4096                       # restaurants of a bucket made by hand; the model has no limit
START = np.uint64(0xA57A27A57A27A571)  # the context of a text's first word
END = np.uint64(0x5D1E0F7E5D1E0F7E)   # the number of the end token
BURN_IN, SAMPLES = 2, 3
STRENGTH = 1.0
BLOCK_CHARS = 8 << 20                 # characters of a block
BUCKET_CHARS = 16 << 20               # and of a bucket, on average
LEAST_BUCKETS = 48


def _pack(*arrays) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(pickle.dumps(arrays, protocol=5))


def _unpack(data: bytes):
    return pickle.loads(zstandard.ZstdDecompressor().decompress(data))


def _narrow(x: np.ndarray) -> np.ndarray:
    top = int(x.max()) if len(x) else 0
    return x.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32)


def tokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(words, contexts, lengths)``: all tokens of the texts with their ends, the context
    of each, and the number of tokens of each text."""
    parts = [word_numbers(texts[a:b]) for a, b in in_slices(texts)]
    numbers = np.concatenate([n for n, _ in parts])
    lengths = np.concatenate([np.diff(bounds) for _, bounds in parts]) + 1
    last = np.cumsum(lengths) - 1
    words = np.empty(int(lengths.sum()), np.uint64)
    inner = np.ones(len(words), bool)
    inner[last] = False
    words[inner], words[last] = numbers, END
    contexts = np.empty(len(words), np.uint64)
    contexts[1:] = words[:-1]
    contexts[last - lengths + 1] = START
    return words, contexts, lengths


def seat(customers: np.ndarray, pull: np.ndarray, discount: float, rng) -> np.ndarray:
    """Tables after the customers of each dish are seated in turn. ``pull``: the restaurant's
    weight of a new table times the dish's probability in the parent."""
    tables = np.minimum(customers, 1).astype(np.int64)
    step = 32
    for k in range(1, step):
        some = np.flatnonzero(customers > k)
        if not len(some):
            return tables
        a = pull[some]
        tables[some] += rng.random(len(some)) < a / (a + k - discount * tables[some])
    low = step
    while True:  # from here on by doubling: new tables of a stretch are nearly Poisson
        some = np.flatnonzero(customers > low)
        if not len(some):
            return tables
        high = np.minimum(customers[some], 2 * low)
        rest = pull[some] - discount * tables[some]
        rate = pull[some] * np.log((high + rest) / (low + rest))
        tables[some] += np.minimum(rng.poisson(rate), high - low)
        low *= 2


@dataclass
class Totals:
    """What a bucket knows of all buckets after a sweep."""
    tables: np.ndarray                       # of the restaurants of the bucket's contexts
    customers_1: float = 0.0                 # of the parent restaurant
    tables_1: float = 0.0
    hot_customers: np.ndarray = field(default_factory=lambda: np.zeros(0))  # of each hot word there
    hot_tables: np.ndarray = field(default_factory=lambda: np.zeros(0))


@dataclass
class Corpus:
    """Counts that stay as they are."""
    tokens: int
    vocabulary: int
    customers: np.ndarray                    # of the restaurants of the bucket's contexts
    hot: np.ndarray                          # hot words, ascending
    hot_counts: np.ndarray
    discount: float
    discount_1: float


class Bucket:
    """Words of one bucket with their pairs (word, context), sorted, and training counts.
    ``singles``: each word's pairs of one customer, if the model leaves them out."""

    def __init__(self, number: int, model: bytes, corpus: Corpus, singles: np.ndarray | None = None):
        self.number, self.corpus = number, corpus
        self.words, runs, context, self.count = (np.asarray(x) for x in _unpack(model))
        self.context = context.astype(np.int64)
        self.word_of = np.repeat(np.arange(len(self.words)), runs)
        self.count = self.count.astype(np.int64)
        at = np.searchsorted(corpus.hot, self.words)
        at[at == len(corpus.hot)] = 0
        self.is_hot = corpus.hot[at] == self.words if len(corpus.hot) else np.zeros(len(self.words), bool)
        self.hot_at = at
        self.word_count = np.bincount(self.word_of, self.count, len(self.words))
        self.word_count[self.is_hot] = corpus.hot_counts[at[self.is_hot]]
        self.tables = np.minimum(self.count, 1)
        self.singles = np.zeros(len(self.words)) if singles is None else singles

    def parents(self) -> np.ndarray:
        """Customers of each word in the parent restaurant (of hot words, from this bucket)."""
        return self.singles + np.bincount(self.word_of, self.tables, len(self.words))

    def word_probability(self, totals: Totals, tables_1: np.ndarray) -> np.ndarray:
        c = self.corpus
        customers = self.parents()
        customers[self.is_hot] = totals.hot_customers[self.hot_at[self.is_hot]]
        tables_1 = tables_1.astype(np.float64)
        tables_1[self.is_hot] = totals.hot_tables[self.hot_at[self.is_hot]]
        fresh = (STRENGTH + c.discount_1 * totals.tables_1) / (c.vocabulary + 1)
        return np.maximum(customers - c.discount_1 * tables_1, 0) / (STRENGTH + totals.customers_1) \
            + fresh / (STRENGTH + totals.customers_1)

    def sweep(self, number: int, before: Totals, tables_1: np.ndarray) -> np.ndarray:
        """Seat all customers again, given the totals of the sweep before; returns the tables
        of the words in the parent restaurant."""
        rng = np.random.default_rng([self.number, number])
        c = self.corpus
        many = np.flatnonzero(self.count > 1)
        if len(many):
            parent = self.word_probability(before, tables_1)[self.word_of[many]]
            pull = (STRENGTH + c.discount * before.tables[self.context[many]]) * parent
            self.tables[many] = seat(self.count[many], pull, c.discount, rng)
        new_weight = (STRENGTH + c.discount_1 * before.tables_1) / (c.vocabulary + 1)
        customers = self.parents().astype(np.int64)
        return seat(customers, np.full(len(customers), new_weight), c.discount_1, rng)

    def replay(self, history: list[Totals]):
        """Yield the parent tables after each sweep; ``history[0]`` are the totals at the start."""
        tables_1 = np.minimum(self.parents(), 1).astype(np.int64)
        for s in range(1, len(history) + 1):
            tables_1 = self.sweep(s, history[s - 1], tables_1)
            yield tables_1

    def predictive(self, totals: Totals, tables_1: np.ndarray) -> np.ndarray:
        """Probability of each pair's word in its context."""
        c = self.corpus
        parent = self.word_probability(totals, tables_1)[self.word_of]
        own = np.maximum(self.count - c.discount * self.tables, 0)
        back = STRENGTH + c.discount * totals.tables[self.context]
        return (own + back * parent) / (STRENGTH + c.customers[self.context])


def _hot_words(texts: DataFrame, buckets: int) -> np.ndarray:
    """Words with a share of at least 1 / (4 * buckets) of all tokens, and no more than
    ``8 * buckets`` words in all: each block reports the words above half that share."""
    def heavy(batches):
        for pdf in batches:
            for a, b in _blocks(pdf["text"]):
                words, _, _ = tokens(pdf["text"].iloc[a:b].tolist())
                found, counts = np.unique(words, return_counts=True)
                high = counts * 8 * buckets >= len(words)
                out = pd.DataFrame({"word": np.append(found[high], np.uint64(0)).view(np.int64),
                                    "n": np.append(counts[high], len(words)), "all": np.append(
                                        np.zeros(int(high.sum()), bool), True)})
                del words, found, counts, high
                release_memory()
                yield out

    seen = (texts.select("text").mapInPandas(heavy, "word long, n long, all boolean")
            .groupBy("all", "word").agg(F.sum("n").alias("n")))
    seen = stage(seen, "lm-hot")
    total = seen.where("all").agg(F.sum("n")).first()[0] or 0
    rows = seen.where(~F.col("all") & (F.col("n") * 8 * buckets >= total)).select("word").collect()
    return np.sort(np.array([r.word for r in rows], np.int64).view(np.uint64))


def _messages(contexts: np.ndarray, groups: int, *values: np.ndarray):
    """``(group, data)`` of the contexts of each group; contexts come sorted by group."""
    ends = np.searchsorted((contexts % np.uint64(groups)).astype(np.int64), np.arange(groups + 1))
    for g in np.flatnonzero(np.diff(ends)):
        here = slice(ends[g], ends[g + 1])
        yield int(g), _pack(contexts[here], *(_narrow(v[here]) for v in values))


def _add_up(messages: list[bytes], sent: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Contexts of the messages, ascending, and the sums of the ``sent`` values of each."""
    if not messages:
        return np.zeros(0, np.uint64), [np.zeros(0, np.int64)] * sent
    parts = [_unpack(m) for m in messages]
    contexts, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return contexts, [np.bincount(at, np.concatenate([p[1 + i] for p in parts]), len(contexts)).astype(np.int64)
                      for i in range(sent)]


def _look_up(contexts: np.ndarray, totals: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """The totals of the asked contexts, 0 for others."""
    if not len(contexts):
        return np.zeros(len(asked), np.int64)
    at = np.minimum(np.searchsorted(contexts, asked), len(contexts) - 1)
    return np.where(contexts[at] == asked, totals[at], 0)


def _answered(answers: pd.DataFrame, values: int) -> list[np.ndarray]:
    """The answers of all groups to one bucket, in the order of its contexts."""
    parts = [_unpack(d) for d in answers.sort_values("group")["data"]]
    return [np.concatenate([np.zeros(0, np.int64), *(p[i].astype(np.int64) for p in parts)]) for i in range(values)]


def _blocks(texts: pd.Series):
    start, held = 0, 0
    for i, t in enumerate(texts):
        if held and held + len(t) > BLOCK_CHARS:
            yield start, i
            start, held = i, 0
        held += len(t) + 1
    if start < len(texts):
        yield start, len(texts)


def score(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` → one row per document: ``doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score, score``; the documents with crc32(id) mod 7 = 2 are held out."""
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))
    doc_id = F.col("doc_id").cast("long")
    texts = docs.select(F.coalesce(doc_id, F.lit(0)).alias("doc_id"), doc_id.isNull().alias("no_id"), held.alias("held_out"),
                        text_or_empty().alias("text"))
    chars = texts.agg(F.sum(F.char_length("text") + 1)).first()[0] or 0
    buckets = max(LEAST_BUCKETS, -(-chars // BUCKET_CHARS))
    hot = _hot_words(texts, buckets)

    def cut(batches):
        from pyspark import TaskContext
        block = TaskContext.get().partitionId() << 32
        for pdf in batches:
            for a, b in _blocks(pdf["text"]):
                part = pdf.iloc[a:b]
                words, contexts, lengths = tokens(part["text"].tolist())
                doc = np.repeat(2 * np.arange(len(part)) + part["held_out"].to_numpy(), lengths)
                del contexts  # of a block, arrays go as soon as they are used: they are what a task holds
                known, word = np.unique(words, return_inverse=True)
                del words
                # Contexts are numbered by group and number, as the buckets keep them.
                values = np.append(known, START)
                by_group = np.lexsort((values, values % np.uint64(buckets)))
                rank = np.empty(len(values), np.uint64)
                rank[by_group] = np.arange(len(values), dtype=np.uint64)
                values = values[by_group]
                context = np.empty(len(word), np.uint64)
                context[1:] = rank[word[:-1]]
                context[np.cumsum(lengths) - lengths] = rank[-1]
                # Word, context and document as one number: its distinct values are the entries.
                docs_bits, bits = int(2 * len(part)).bit_length(), len(known).bit_length()
                pair, pairs = (word.astype(np.uint64) << np.uint64(bits)) | context, None
                if 2 * bits + docs_bits > 64:
                    pairs, pair = np.unique(pair, return_inverse=True)
                one = (pair.astype(np.uint64) << np.uint64(docs_bits)) | doc.astype(np.uint64)
                del word, context, pair
                one, times = np.unique(one, return_counts=True)
                doc = (one & np.uint64((1 << docs_bits) - 1)).astype(np.int64)
                pair = one >> np.uint64(docs_bits)
                del one
                pair = pair if pairs is None else pairs[pair.astype(np.int64)]
                context = (pair & np.uint64((1 << bits) - 1)).astype(np.int64)
                word = (pair >> np.uint64(bits)).astype(np.int64)
                del pair, pairs
                target = (known % np.uint64(buckets))[word]
                is_hot = np.isin(known, hot)[word]
                target[is_hot] = mix(known[word[is_hot]] ^ mix(values[context[is_hot]])) % np.uint64(buckets)
                order = np.argsort(target.astype(np.int32), kind="stable")
                ends = np.searchsorted(target[order], np.arange(buckets + 1))
                rows = [(-1 - (block >> 32) % 64, block,
                         _pack(part["no_id"].to_numpy(), part["doc_id"].to_numpy(), part["held_out"].to_numpy(),
                               lengths))]
                for k in range(buckets):
                    i = order[ends[k]:ends[k + 1]]
                    if len(i):
                        own, runs = np.unique(word[i], return_counts=True)
                        before, at = np.unique(context[i], return_inverse=True)
                        rows.append((k, block, _pack(known[own], _narrow(runs), values[before], _narrow(at),
                                                     _narrow(doc[i]), _narrow(times[i]))))
                del part, lengths, doc, times, known, values, by_group, rank, context, word, target, is_hot, order
                release_memory()
                yield pd.DataFrame(rows, columns=["bucket", "block", "data"])
                block += 1

    held_columns = ["kind", "bucket", "group", "block", "model", "entries", "core", "message", "stats"]

    def merge(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        number = int(key[0])
        if number < 0:  # what the blocks know about their documents
            return pd.DataFrame({"kind": "about", "bucket": number, "block": pdf["block"], "entries": pdf["data"]}).reindex(
                columns=held_columns).astype({"group": "Int32"})
        pdf = pdf.sort_values("block")
        parts = [_unpack(d) for d in pdf["data"]]
        words = np.unique(np.concatenate([p[0] for p in parts]))
        sorted_contexts = np.unique(np.concatenate([p[2] for p in parts]))
        by_group = np.lexsort((sorted_contexts, sorted_contexts % np.uint64(buckets)))
        contexts, size = sorted_contexts[by_group], len(by_group)
        rank = np.empty(size, np.int64)
        rank[by_group] = np.arange(size)
        pairs = [np.repeat(np.searchsorted(words, p[0]), p[1]).astype(np.int64) * size
                 + rank[np.searchsorted(sorted_contexts, p[2])][p[3]] for p in parts]
        known = np.unique(np.concatenate(pairs))
        count = np.zeros(len(known), np.int64)
        entries = []
        for block, p, pair in zip(pdf["block"], parts, pairs):
            at = np.searchsorted(known, pair)
            count += np.bincount(at, p[5].astype(np.int64) * (1 - (p[4] & 1)), len(known)).astype(np.int64)
            entries.append((int(block), _narrow(np.diff(at, prepend=0)), p[4], p[5]))
        word, context = known // size, known % size
        trained = count > 0
        per_word = np.bincount(word, count, len(words)).astype(np.int64)
        is_hot = np.isin(words, hot)
        tables = np.bincount(context[trained], minlength=size)
        customers = np.bincount(context, count, size).astype(np.int64)
        parents = np.bincount(word[trained], minlength=len(words))
        cold = ~is_hot & (per_word > 0)
        stats = _pack(words[is_hot], per_word[is_hot], parents[is_hot], int(cold.sum()),
                      int(parents[cold].sum()), int((count == 1).sum()), int((count == 2).sum()),
                      int((parents[cold] == 1).sum()), int((parents[cold] == 2).sum()), int(count.sum()))
        model = _pack(words, _narrow(np.bincount(word, minlength=len(words))), _narrow(context), _narrow(count))
        # What sweeps change: the pairs with more than one customer, and their contexts.
        many = count > 1
        moving = np.bincount(context[many], minlength=size) > 0
        singles = np.bincount(word[count == 1], minlength=len(words))
        core = _pack(_pack(words, _narrow(np.bincount(word[many], minlength=len(words))),
                           _narrow((np.cumsum(moving) - 1)[context[many]]), _narrow(count[many])),
                     _narrow(singles), contexts[moving], None, None, None)
        rows = [("model", number, None, -1, model, _pack(*entries), None, None, stats),
                ("core", number, None, -1, None, None, core, None, None)]
        rows += [("message", number, g, -1, None, None, None, data, None)
                 for g, data in _messages(contexts, buckets, tables, customers, moving.astype(np.uint8))]
        del parts, pairs, known, word, context, count, entries, words, rank, sorted_contexts, contexts
        release_memory()
        return pd.DataFrame(rows, columns=held_columns).astype({"group": "Int32"})

    spark = docs.sparkSession
    with shuffles_freed(spark):
        held_rows, held_at = stage_parts(texts.mapInPandas(cut, "bucket int, block long, data binary").groupBy(
            "bucket").applyInPandas(
                merge, "kind string, bucket int, group int, block long, model binary, entries binary, core binary, "
                       "message binary, stats binary"), "lm-buckets", "kind")

    def add_up(rows: DataFrame, names: int) -> dict[str, np.ndarray]:
        """Sum rows ``kind, at, v0, …`` over the buckets: one row per total or hot word."""
        sums = [F.sum(f"v{i}").alias(f"v{i}") for i in range(names)]
        got = stage(rows.groupBy("kind", "at").agg(*sums), "lm-totals").toPandas()
        return {k: g.sort_values("at") for k, g in got.groupby("kind")}

    def dense(got, kind: str, column: str, size: int) -> np.ndarray:
        out = np.zeros(size)
        if kind in got:
            out[got[kind]["at"].to_numpy()] = got[kind][column].to_numpy(np.float64)
        return out

    def first_totals(batches):
        for pdf in batches:
            for data in pdf["stats"]:
                words, counts, parents, *scalars = _unpack(data)
                at = np.searchsorted(hot, words)
                yield pd.concat([
                    pd.DataFrame({"kind": "h", "at": at, "v0": counts, "v1": parents}),
                    pd.DataFrame({"kind": "s", "at": np.arange(len(scalars)), "v0": scalars, "v1": 0})])

    mine = held_rows.where("kind = 'model'")
    first = held_rows.where("kind = 'message'").select("group", "bucket", F.lit(0).alias("sweep"), "message")
    got = add_up(mine.select("stats").mapInPandas(first_totals, "kind string, at int, v0 long, v1 long"), 2)
    hot_counts, hot_parents = dense(got, "h", "v0", len(hot)), dense(got, "h", "v1", len(hot))
    v, p, n1, n2, m1, m2, n = dense(got, "s", "v0", 7)
    ratio = lambda a, b: float(np.clip(a / (a + 2 * b), 0.1, 0.95)) if a + b else 0.5
    nothing = np.zeros(0)
    corpus = Corpus(int(n), int(v + (hot_counts > 0).sum()), nothing, hot, hot_counts, ratio(n1, n2), ratio(m1, m2))
    history = [Totals(nothing, p + hot_parents.sum(), v + (hot_parents > 0).sum(),
                      hot_parents, np.minimum(hot_parents, 1))]

    def answer_first(pdf: pd.DataFrame) -> pd.DataFrame:
        """Each bucket's moving contexts: the tables of their restaurants before the first sweep."""
        contexts, (tables,) = _add_up(list(pdf["message"]), 1)
        rows = []
        for bucket, group, data in zip(pdf["bucket"], pdf["group"], pdf["message"]):
            asked, _, _, moving = _unpack(data)
            if moving.any():
                rows.append((bucket, group, _pack(_narrow(_look_up(contexts, tables, asked[moving > 0])))))
        return pd.DataFrame(rows, columns=["bucket", "group", "data"])

    def answer(pdf: pd.DataFrame) -> pd.DataFrame:
        """The tables of a sweep beyond the first of each pair."""
        contexts, (more,) = _add_up(list(pdf["message"]), 1)
        return pd.DataFrame([(bucket, group, _pack(_narrow(_look_up(contexts, more, _unpack(data)[0]))))
                             for bucket, group, data in zip(pdf["bucket"], pdf["group"], pdf["message"])],
                            columns=["bucket", "group", "data"])

    def answer_all(pdf: pd.DataFrame) -> pd.DataFrame:
        """All contexts of each bucket: customers, first tables, and what each sweep added."""
        asks = pdf[pdf["sweep"] == 0]
        contexts, (tables, customers) = _add_up(list(asks["message"]), 2)
        by_sweep = [_add_up(list(pdf.loc[pdf["sweep"] == s, "message"]), 1) for s in range(1, BURN_IN + SAMPLES + 1)]
        rows = []
        for bucket, group, data in zip(asks["bucket"], asks["group"], asks["message"]):
            asked = _unpack(data)[0]
            rows.append((bucket, group, _pack(
                _narrow(_look_up(contexts, customers, asked)), _narrow(_look_up(contexts, tables, asked)),
                *(_narrow(_look_up(c, more, asked)) for c, (more,) in by_sweep))))
        return pd.DataFrame(rows, columns=["bucket", "group", "data"])

    def answers(messages: DataFrame, function) -> DataFrame:
        return messages.groupBy("group").applyInPandas(function, "bucket int, group int, data binary")

    def sweep(s: int, before: Totals):
        def run(core: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
            number = int(core["bucket"].iloc[0])
            model, singles, contexts, tables, tables_1, first_tables = _unpack(core["data"].iloc[0])
            heard, = _answered(told, 1)
            bucket = Bucket(number, model, corpus, singles.astype(np.int64))
            if s == 1:
                first_tables = heard
                tables_1 = np.minimum(bucket.parents(), 1)
            else:
                bucket.tables = tables.astype(np.int64)
                heard = heard + first_tables
            tables_1 = bucket.sweep(s, replace(before, tables=heard), tables_1.astype(np.int64))
            more = np.bincount(bucket.context, bucket.tables - 1, len(contexts)).astype(np.int64)
            parents, cold = bucket.parents(), ~bucket.is_hot
            core = _pack(model, singles, contexts, _narrow(bucket.tables), _narrow(tables_1), _narrow(first_tables))
            sends = list(_messages(contexts, buckets, more))
            hot_at = bucket.hot_at[bucket.is_hot]
            columns = ["kind", "at", "bucket", "v0", "core", "message"]
            return pd.concat([
                pd.DataFrame([("core", number, number, 0, core, None)] + [("message", g, number, 0, None, data)
                                                                          for g, data in sends], columns=columns),
                pd.DataFrame({"kind": "h", "at": hot_at, "bucket": number, "v0": parents[bucket.is_hot].astype(np.int64),
                              "core": None, "message": None}),
                pd.DataFrame({"kind": "s", "at": [0, 1], "bucket": number, "v0": [
                    int(parents[cold].sum()), int(tables_1[cold].sum())], "core": None, "message": None})])

        return run

    cores, cores_at = held_rows.where("kind = 'core'").select("bucket", F.col("core").alias("data")), held_at
    sent, sent_at, told = first, [held_at], answers(first, answer_first)
    for s in range(1, BURN_IN + SAMPLES + 1):
        with shuffles_freed(spark):
            rows, at = stage_parts(cores.groupBy("bucket").cogroup(told.groupBy("bucket")).applyInPandas(
                sweep(s, history[-1]), "kind string, at int, bucket int, v0 long, core binary, message binary"),
                "lm-sweep", "kind")
        discard_part(spark, cores_at, "kind", "core")  # the seatings before
        cores, cores_at = rows.where("kind = 'core'").select("bucket", F.col("core").alias("data")), at
        sent_at.append(at)
        messages = rows.where("kind = 'message'").select(F.col("at").alias("group"), "bucket", F.lit(s).alias("sweep"),
                                                   "message")
        sent, told = sent.union(messages), answers(messages, answer)
        got = add_up(rows.where("kind IN ('h', 's')").select("kind", "at", "v0"), 1)
        hot_customers = dense(got, "h", "v0", len(hot))
        last = history[-1]
        weight = (STRENGTH + corpus.discount_1 * last.tables_1) / (corpus.vocabulary + 1)
        hot_tables = seat(hot_customers.astype(np.int64), np.full(len(hot), weight), corpus.discount_1,
                          np.random.default_rng([1 << 30, s])).astype(float)
        sums = dense(got, "s", "v0", 2)
        history.append(Totals(nothing, sums[0] + hot_customers.sum(),
                              sums[1] + hot_tables.sum(), hot_customers, hot_tables))

    def rate(held: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        number, model, entries = held[["bucket", "model", "entries"]].iloc[0]
        customers, first_tables, *more = _answered(told, 2 + BURN_IN + SAMPLES)
        known = [replace(h, tables=first_tables + m) for h, m in zip(history, [0, *more])]
        bucket = Bucket(int(number), model, replace(corpus, customers=customers))
        mean = np.zeros(len(bucket.count))
        for s, tables_1 in enumerate(bucket.replay(known[:-1]), 1):
            if s > BURN_IN:
                mean += bucket.predictive(known[s], tables_1) / SAMPLES
        log_p = np.log10(mean)
        seen = bucket.word_count[bucket.word_of]
        log_c, is_known = np.log10(seen + 1), (seen > 0).astype(np.int64)
        rows = []
        for block, step, doc, times in _unpack(entries):
            at, doc = np.cumsum(step, dtype=np.int64), doc.astype(np.int64) >> 1
            here, doc = np.unique(doc, return_inverse=True)
            rows.append((block, 1, _pack(
                _narrow(here), np.bincount(doc, times * log_p[at]), np.bincount(doc, times * log_c[at]),
                _narrow(np.bincount(doc, times * is_known[at]).astype(np.int64)))))
        del bucket, known, more, mean, log_p, log_c, seen, is_known
        release_memory()
        return pd.DataFrame(rows, columns=["block", "kind", "data"])

    discard_part(spark, cores_at, "kind", "core")
    with shuffles_freed(spark):
        told = stage(answers(sent, answer_all), "lm-answers")
    for at in sent_at:
        discard_part(spark, at, "kind", "message")

    partial = mine.select("bucket", "model", "entries").groupBy("bucket").cogroup(
        told.groupBy("bucket")).applyInPandas(rate, "block long, kind int, data binary")
    about = held_rows.where("kind = 'about'").select("block", F.lit(0).alias("kind"), F.col("entries").alias("data"))
    slots = np.log10(float(corpus.tokens + corpus.vocabulary + 1))

    def gather(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        no_id, ids, held_out, lengths = _unpack(pdf.loc[pdf["kind"] == 0, "data"].iloc[0])
        sums = np.zeros((3, len(ids)))
        for data in pdf.loc[pdf["kind"] == 1, "data"]:
            here, *values = _unpack(data)
            for i, x in enumerate(values):
                sums[i][here] += x
        return pd.DataFrame({"doc_id": np.where(no_id, None, ids.astype(object)) if no_id.any() else ids,
                             "held_out": held_out, "n_tokens": lengths, "n_known": sums[2].astype(np.int64),
                             "train_tokens": corpus.tokens, "base_score": sums[1] - lengths * slots,
                             "score": sums[0]})

    return about.union(partial).groupBy("block").applyInPandas(
        gather, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                "base_score double, score double")
