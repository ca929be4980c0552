"""Phrase collocations by mergeable Misra-Gries summaries.

Which phrases of one to four words occur ``least`` times in a language is found in two steps.
First every batch of documents counts its phrases and sends the counts to the hash partition of
the phrase's fingerprint. A partition merges what it gets into one Misra-Gries summary: more than
``mass / least`` counters, and whenever there are more, the largest counter beyond the capacity is
taken off all of them. At most ``mass / (capacity + 1) < least`` can be taken off a counter that
way, so every phrase with ``least`` occurrences survives. Pairs of words are summarised first;
phrases of three and four words enter only where all their pairs survive (a phrase is no more
frequent than its parts). The second pass then counts the survivors exactly, by their words: a batch
counts its own, and the hash partitions add up what all batches send them.

A summary's memory is bounded by the mass of its partition, and partitions grow in number with the
corpus. A frequent phrase reaches its partition once per batch, with a count.

Scores are exact: products are decimals of 38 digits, quotients are whole. The first phrases of a
language are found by range-sorting all candidates and adding up the ranges before, so a language
with most of the rows never lies in one task.

Defined cases: null and empty texts have no words; a null language is ``und``; words are runs
without blanks in a piece; ties in score go by count, then by the phrase's bytes; repeated rows
count each; an empty table gives no rows; further columns are ignored. Survivors' exact counts
are kept by a 64-bit fingerprint inside a batch (two different phrases of a batch of 10^6 words are
taken for one with a probability of 10^-7).
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import stage, text_or_empty
from strata.llm.runs import (arrays, batch_counts, batch_number, cuts, keyed, members, received, rolling,
                             split_words, text_slices)
from strata.llm.words import mix

BREAKS, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
LONGEST, LEAST, TOP = 4, 30, 2000
# A phrase goes if a longer one that holds it has this share of its occurrences, in per cent.
INSIDE_PERCENT = 80
SCALE = 2_000_000

COUNTS = "batch bigint, bucket bigint, once binary, more binary, counts binary"
SURVIVORS = "batch bigint, bucket bigint, prints binary"
PACKED = "bucket bigint, n bigint, phrases binary"
# The language with its length before it, and the phrase (empty for the number of all words).
EXACT = "key string, f bigint"
_KINDS = {"bigint": pa.int64(), "binary": pa.binary(), "string": pa.string()}


def _table(schema: str, **columns) -> pa.Table:
    fields = [pa.field(name, _KINDS[kind]) for name, kind in (c.split(" ") for c in schema.split(", "))]
    return pa.table([pa.array(columns.get(f.name, []), f.type) for f in fields], schema=pa.schema(fields))


class _Grams:
    """Words of some texts and the fingerprints of their phrases, each with its language."""

    def __init__(self, texts: list[str], langs: list[str]):
        self.words = split_words(texts, BLANKS, BREAKS, lower=True)
        names = sorted(set(langs))
        salt = split_words([f"l{n.encode().hex()}" for n in names], b"").numbers
        per_text = salt[[names.index(n) for n in langs]] if names else salt
        self.salt = np.repeat(per_text, np.diff(self.words.bounds))

    def prints(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of the phrases of ``width`` words in one piece, and their fingerprints."""
        at = np.flatnonzero(self.words.runs(width))
        prints = rolling(self.words.numbers, width)[at]
        return at, mix(prints ^ mix(self.salt[at] + np.uint64(width)))

    def longer(self, width: int, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Phrases of ``width`` words all whose pairs (flags by place) survive."""
        at, prints = self.prints(width)
        whole = np.ones(len(at), bool)
        for j in range(width - 1):
            whole &= pairs[at + j]
        return at[whole], prints[whole]


def _slices(docs: pa.Table):
    langs = docs.column("lang").to_pylist()
    for first, texts in text_slices(docs.column("text").to_pylist()):
        yield _Grams(texts, langs[first:first + len(texts)]), langs[first:first + len(texts)]


def _counted(batch: int, keys: list[np.ndarray], buckets: int) -> pa.Table:
    """A batch's counts, a row for each bucket."""
    values, n = np.unique(np.concatenate([np.zeros(0, np.uint64), *keys]), return_counts=True)
    more = n > 1
    once, often, counts = values[~more], values[more], n[more].astype(np.uint32)
    a, b = cuts(once, buckets), cuts(often, buckets)
    used = np.flatnonzero(np.diff(a) + np.diff(b))

    def parts(x, c):
        return [x[c[i]:c[i + 1]].tobytes() for i in used]

    return _table(COUNTS, batch=np.full(len(used), batch), bucket=used, once=parts(once.astype(np.uint32), a),
                  more=parts(often.astype(np.uint32), b), counts=parts(counts, b))


def _pairs(grams: _Grams, wanted: np.ndarray, buckets: int) -> np.ndarray:
    flags = np.zeros(len(grams.words.numbers) + LONGEST, bool)
    at, prints = grams.prints(2)
    flags[at[members(keyed(prints, buckets), wanted)]] = True
    return flags


def _short(buckets: int):
    def run(docs: pa.Table) -> pa.Table:
        """Counts of the words and pairs of a batch."""
        keys = [keyed(grams.prints(width)[1], buckets) for grams, _ in _slices(docs) for width in (1, 2)]
        return _counted(docs.column("batch")[0].as_py(), keys, buckets)

    return run


def _long(buckets: int, longest: int):
    def run(docs: pa.Table, pairs: pa.Table) -> pa.Table:
        """Counts of the longer phrases of a batch all whose pairs survive."""
        if not docs.num_rows or not pairs.num_rows:
            return _table(COUNTS)
        wanted, keys = received(pairs), []
        for grams, _ in _slices(docs):
            flags = _pairs(grams, wanted, buckets)
            keys += [keyed(grams.longer(width, flags)[1], buckets) for width in range(3, longest + 1)]
        return _counted(docs.column("batch")[0].as_py(), keys, buckets)

    return run


class Summary:
    """A Misra-Gries summary of ``capacity`` counters at most; summaries and counts merge."""

    def __init__(self, capacity: int):
        self.capacity, self.taken = capacity, 0
        self.keys, self.counters = np.zeros(0, np.uint32), np.zeros(0, np.int64)

    def merge(self, keys: list[np.ndarray], counts: list[np.ndarray]):
        keys, counts = np.concatenate([self.keys, *keys]), np.concatenate([self.counters, *counts])
        if not len(keys):
            return
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        keys, counts = keys[first], np.add.reduceat(counts, first)
        if len(keys) > self.capacity:
            off = np.partition(counts, len(counts) - self.capacity - 1)[len(counts) - self.capacity - 1]
            self.taken += int(off)
            keys, counts = keys[counts > off], counts[counts > off] - off
        self.keys, self.counters = keys, counts

    def at_least(self, least: int) -> np.ndarray:
        """Keys that may have occurred ``least`` times; none that has is left out if the capacity
        exceeds the mass divided by ``least``."""
        return self.keys[self.counters + self.taken >= least]


def _survivors(least: int, pending: int = 1 << 20):
    def run(table: pa.Table) -> pa.Table:
        once, more = arrays(table.column("once"), np.uint32), arrays(table.column("more"), np.uint32)
        counts = arrays(table.column("counts"), np.uint32)
        mass = sum(map(len, once)) + sum(int(c.sum(dtype=np.int64)) for c in counts)
        summary, keys, sums, held = Summary(mass // least + 1), [], [], 0
        for o, m, c in zip(once, more, counts):
            keys += [o, m]
            sums += [np.ones(len(o), np.int64), c.astype(np.int64)]
            held += len(o) + len(m)
            if held >= pending:
                summary.merge(keys, sums)
                keys, sums, held = [], [], 0
        summary.merge(keys, sums)
        stay = summary.at_least(least)
        out = [np.concatenate([o[members(o, stay)], m[members(m, stay)]]) for o, m in zip(once, more)]
        rows = [i for i, o in enumerate(out) if len(o)]
        return _table(SURVIVORS, batch=table.column("batch").to_numpy()[rows],
                      bucket=table.column("bucket").to_numpy()[rows], prints=[out[i].tobytes() for i in rows])

    return run


def _exact(buckets: int, longest: int):
    def run(docs: pa.Table, survivors: pa.Table) -> pa.Table:
        """Exact counts of the survivors in a batch, by their words; the words of each language
        in all as the phrase null."""
        wanted, slices, places, prints, total = received(survivors), [], [], [], {}
        for grams, names in _slices(docs):
            sizes = np.diff(grams.words.bounds)
            for name, n in zip(names, sizes.tolist()):
                total[name] = total.get(name, 0) + n
            flags = _pairs(grams, wanted, buckets)
            for width in range(1, longest + 1):
                at, p = grams.prints(width) if width < 3 else grams.longer(width, flags)
                stay = members(keyed(p, buckets), wanted)
                places.append((len(slices), width, at[stay]))
                prints.append(p[stay])
            slices.append((grams.words, names, np.repeat(np.arange(len(names)), sizes)))
        prefix = {name: f"{len(name)}:{name}".encode() for name in total}
        # The number of all words goes with the empty phrase of its language.
        keys, found = list(prefix.values()), [np.array(list(total.values()), np.int64)]
        homes = [np.array([zlib.crc32(k) % buckets for k in keys], np.int64)]
        values, first, counts = np.unique(np.concatenate([np.zeros(0, np.uint64), *prints]), return_index=True,
                                          return_counts=True)
        order = np.argsort(first)
        values, first, counts = values[order], first[order], counts[order]
        begin = np.cumsum([0, *map(len, prints)])
        for (k, width, at), a, b in zip(places, begin[:-1], begin[1:]):
            mine = slice(*np.searchsorted(first, [a, b]))  # phrases met first in this slice
            words, names, text_of = slices[k]
            at = at[first[mine] - a]
            spelled = [map(words.data.__getitem__, map(slice, words.starts[at + j].tolist(), words.ends[at + j].tolist()))
                       for j in range(width)]
            keys += [prefix[names[i]] + b" ".join(x) for i, x in zip(text_of[at].tolist(), zip(*spelled))]
            found.append(counts[mine])
            homes.append((keyed(values[mine], buckets) >> np.uint64(32)).astype(np.int64))
        return _packed(keys, np.concatenate(found), np.concatenate(homes))

    return run


def _packed(keys: list[bytes], counts: np.ndarray, homes: np.ndarray) -> pa.Table:
    """A row for each bucket: its phrases, in about alphabetical order, and their counts, compressed."""
    order = np.lexsort((np.array([k[:24] for k in keys], "S24"), homes))
    counts, homes, lengths = counts[order], homes[order], np.array(list(map(len, keys)), np.uint32)[order]
    keys = list(map(keys.__getitem__, order.tolist()))
    used, begin = np.unique(homes, return_index=True)
    rows = []
    for a, b in zip(begin.tolist(), [*begin[1:].tolist(), len(keys)]):
        rows.append(zlib.compress(counts[a:b].astype("<i8").tobytes() + lengths[a:b].tobytes() + b"".join(keys[a:b]), 1))
    return _table(PACKED, bucket=used, n=np.diff([*begin, len(keys)]), phrases=rows)


def _add_up(least: int):
    def run(table: pa.Table) -> pa.Table:
        """A bucket: exact counts of its phrases over all batches, those of ``least`` at least."""
        total: dict[bytes, int] = {}
        for n, packed in zip(table.column("n").to_pylist(), table.column("phrases").to_pylist()):
            data = zlib.decompress(packed)
            ends = (12 * n + np.cumsum(np.frombuffer(data, np.uint32, n, 8 * n), dtype=np.int64)).tolist()
            for a, b, c in zip([12 * n, *ends], ends, np.frombuffer(data, "<i8", n).tolist()):
                key = data[a:b]
                total[key] = total.get(key, 0) + c
        kept = [(k, f) for k, f in ((k.decode(), f) for k, f in total.items() if f >= least or _is_total(k))]
        return _table(EXACT, key=[k for k, _ in kept], f=[f for _, f in kept])

    return run


def _is_total(key: bytes) -> bool:
    size, _, rest = key.decode().partition(":")
    return len(rest) == int(size)


def counts(docs: DataFrame, least: int = LEAST, longest: int = LONGEST) -> DataFrame:
    """``docs(lang, text, …)`` → ``lang, phrase, words, f`` of every phrase of up to ``longest`` words
    that occurs ``least`` times in its language, and a row with the phrase null and 0 words that has
    the number of all words of the language."""
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
                       text_or_empty().alias("text"),
                       (F.col("doc_id") if "doc_id" in docs.columns else F.lit(0)).alias("doc_id"))
    batches, buckets = batch_counts(rows)
    rows = rows.select("lang", "text", batch_number(batches, "doc_id", "text"))
    short = rows.groupBy("batch").applyInArrow(_short(buckets), COUNTS)
    pairs = short.groupBy("bucket").applyInArrow(_survivors(least), SURVIVORS)
    long = rows.groupBy("batch").cogroup(pairs.groupBy("batch")).applyInArrow(_long(buckets, longest), COUNTS)
    more = long.groupBy("bucket").applyInArrow(_survivors(least), SURVIVORS)
    exact = rows.groupBy("batch").cogroup(pairs.union(more).groupBy("batch")).applyInArrow(
        _exact(buckets, longest), PACKED).groupBy("bucket").applyInArrow(_add_up(least), EXACT)
    size = F.substring_index("key", ":", 1)
    begin = F.length(size) + 2
    found = exact.select(
        F.substr("key", begin, size.cast("int")).alias("lang"),
        F.nullif(F.substr("key", begin + size.cast("int")), F.lit("")).alias("phrase"), "f")
    words = F.when(F.col("phrase").isNull(), 0).otherwise(F.size(F.split("phrase", " ")))
    return found.select("lang", "phrase", words.cast("long").alias("words"), "f")


def score(found: DataFrame) -> DataFrame:
    """:func:`counts` → ``lang, phrase, a, l, r, n, score`` of all phrases of two words and more that no
    longer one makes superfluous; the lowest-scoring cut counts, the first of equal ones."""
    phrases = found.where("words > 0").select("lang", "phrase", "words", "f")
    candidates = phrases.where("words > 1").withColumn("ws", F.split("phrase", " "))
    cut = candidates.select("lang", "phrase", F.col("f").alias("a"),
                            F.explode(F.sequence(F.lit(1), F.col("words").cast("int") - 1)).alias("k"))
    part = phrases.select("lang", F.col("phrase").alias("part"), "f")
    for name, words in (("l", F.slice(F.split("phrase", " "), F.lit(1), F.col("k"))),
                        ("r", F.slice(F.split("phrase", " "), F.col("k") + 1, F.lit(1 << 30)))):
        cut = (cut.withColumn("part", F.array_join(words, " ")).join(part, ["lang", "part"]).drop("part")
               .withColumnRenamed("f", name))
    big = "decimal(38,0)"
    value = F.expr(f"cast(a as decimal(28,0)) * cast({SCALE} as decimal(9,0)) div (cast(l as {big}) + cast(r as {big}))")
    scored = cut.select("lang", "phrase", "a", F.struct(value.cast("long").alias("score"), "k", "l", "r").alias("m")) \
        .groupBy("lang", "phrase", "a").agg(F.min("m").alias("m"))
    # Every phrase inside a longer one, with the occurrences of the most frequent one.
    spans = F.expr("flatten(transform(sequence(2, cast(words as int) - 1), n -> "
                   "transform(sequence(1, cast(words as int) - n + 1), i -> array_join(slice(ws, i, n), ' '))))")
    inside = (candidates.where("words > 2").select("lang", F.explode(spans).alias("phrase"), "f")
              .groupBy("lang", "phrase").agg(F.max("f").alias("longer")))
    total = found.where("phrase IS NULL").select(F.col("lang").alias("t_lang"), F.col("f").alias("n"))
    return (scored.join(inside, ["lang", "phrase"], "left")
            .where(f"longer IS NULL OR longer * 100 < a * {INSIDE_PERCENT}")
            .join(total, F.col("lang") == F.col("t_lang"))
            .select("lang", "phrase", "a", "m.l", "m.r", "n", "m.score"))


def first_by_lang(scored: DataFrame, top: int = TOP) -> DataFrame:
    """The first ``top`` rows of each language by score, count and phrase, with their ``rank`` from 1.

    All rows are range-sorted, every range knows how many rows of the language lie before it, and
    only ranges that reach into the first ``top`` are ranked."""
    order = ["lang", F.col("score").desc(), F.col("a").desc(), "phrase"]
    spark = scored.sparkSession
    ranges = stage(scored.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order)
                   .withColumn("range", F.spark_partition_id()), "phrase-ranges")
    sizes = ranges.groupBy("lang", "range").agg(F.count(F.lit(1)).alias("size"))
    upto = Window.partitionBy("lang").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("lang", "range", F.coalesce(F.sum("size").over(upto), F.lit(0)).alias("before")).where(
        F.col("before") < top)
    inside = Window.partitionBy("lang", "range").orderBy(*order[1:])
    return (ranges.join(before, ["lang", "range"])
            .withColumn("rank", (F.row_number().over(inside) + F.col("before")).cast("long"))
            .where(F.col("rank") <= top)
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP) -> DataFrame:
    """The first ``top`` phrases of each language: ``lang, rank, phrase, a, l, r, n, score``."""
    found = stage(counts(docs, least, longest), "phrase-counts")
    return first_by_lang(score(found), top)
