"""Phrase mining against brute force, and the summaries' guarantee."""

import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.llm import phrases

SCHEMA = "doc_id long, lang string, text string"
COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def brute(rows, least, top):
    freq, n = defaultdict(Counter), Counter()
    for _, lang, text in rows:
        lang, text = lang or "und", text or ""
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", re.sub("[A-Z]", lambda m: m[0].lower(), text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, 5):
                freq[lang].update(" ".join(words[i:i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, f in freq.items():
        candidates = {p: a for p, a in f.items() if " " in p and a >= least}
        gone = set()
        for longer, b in candidates.items():
            w = longer.split(" ")
            for size in range(2, len(w)):
                for i in range(len(w) - size + 1):
                    inner = " ".join(w[i:i + size])
                    if 100 * b >= 80 * f[inner]:
                        gone.add(inner)
        scored = []
        for p, a in candidates.items():
            if p not in gone:
                w, best = p.split(" "), None
                for k in range(1, len(w)):
                    left, right = f[" ".join(w[:k])], f[" ".join(w[k:])]
                    cut = (2000000 * a // (left + right), k, left, right)
                    best = min(best or cut, cut)
                scored.append((-best[0], -a, p.encode(), best))
        for rank, (s, a, p, cut) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, cut[2], cut[3], n[lang], -s))
    return sorted(out)


def run(spark, rows, least, top):
    df = phrases.collocations(spark.createDataFrame(rows, SCHEMA).repartition(4), least, 4, top)
    assert df.columns == COLUMNS
    return sorted(map(tuple, df.collect()))


def texts(seed=3, n=150):
    rnd = random.Random(seed)
    vocabulary = ["the", "The", "of", "a\xa0b", "é", "É", "new", "york", "city", "x1", "_", "ﬁ", "日本", "w", "\x1f", "1:2"]
    gaps = [" "] * 8 + ["  ", "\t", ", ", ".", "! ", "\n", "\x0b", ";", " : ", "?"]
    return [(i, rnd.choice(["en", "de", None, "und", "3:x"]),
             "".join(rnd.choice(vocabulary) + rnd.choice(gaps) for _ in range(rnd.randrange(60)))) for i in range(n)]


def test_collocations_equal_brute_force(spark):
    rows = texts()
    for least, top in ((3, 2000), (5, 7), (1, 40)):
        assert run(spark, rows, least, top) == brute(rows, least, top)


def test_defined_cases(spark):
    rows = [(1, "en", None), (2, "en", ""), (3, None, "a b. a b. a b"), (3, None, "a b. a b. a b"), (4, "und", "A B"),
            (None, "en", "x x x x x x x x"), (5, "zz", " .,;\n"), (6, "en", "p q r s " * 2000 + ".")]
    assert run(spark, rows, 3, 100) == brute(rows, 3, 100)
    assert phrases.collocations(spark.createDataFrame([], SCHEMA)).collect() == []
    wide = spark.createDataFrame([("en", "a b a b", "k", 1)], "lang string, text string, key string, batch int")
    assert {r.phrase for r in phrases.collocations(wide, 2).collect()} == {"a b"}


def test_a_language_and_a_phrase_that_hold_most_rows(spark):
    rows = [(i, "en", "hot phrase here") for i in range(3000)] + [(i, "de", f"wort{i % 9} und") for i in range(300)]
    assert run(spark, rows, 30, 2000) == brute(rows, 30, 2000)


def test_products_beyond_64_bits(spark):
    a = 9_000_000_000_000_000
    found = spark.createDataFrame([("en", "x y", 2, a), ("en", "x", 1, a + 7), ("en", "y", 1, a + 1), ("en", None, 0, 3 * a)],
                                  "lang string, phrase string, words long, f long")
    got = phrases.score(found).collect()
    assert [(r.a, r.l, r.r, r.n, r.score) for r in got] == [
        (a, a + 7, a + 1, 3 * a, int(Fraction(2000000 * a, 2 * a + 8)))]


def test_ranks_over_ranges(spark):
    rnd = random.Random(1)
    rows = [(rnd.choice("aab"), f"p{i}", rnd.randrange(5), rnd.randrange(4)) for i in range(3000)]
    df = spark.createDataFrame(rows, "lang string, phrase string, a long, score long").withColumns(
        {c: F.lit(0).cast("long") for c in "lrn"}).repartition(8)
    got = sorted((r.lang, r["rank"], r.phrase) for r in phrases.first_by_lang(df, 700).collect())
    want = []
    for lang in "ab":
        mine = sorted((-s, -a, p) for g, p, a, s in rows if g == lang)[:700]
        want += [(lang, i, p) for i, (_, _, p) in enumerate(mine, 1)]
    assert got == sorted(want)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.tuples(st.integers(0, 25), st.integers(1, 9)), max_size=12), max_size=12), st.integers(1, 12))
def test_summaries_lose_no_frequent_key(batches, least):
    total = Counter()
    for b in batches:
        for k, n in b:
            total[k] += n
    summary = phrases.Summary(sum(total.values()) // least + 1)
    for b in batches:
        summary.merge([np.array([k for k, _ in b], np.uint32)], [np.array([n for _, n in b], np.int64)])
        assert len(summary.keys) <= summary.capacity
    frequent = {k for k, n in total.items() if n >= least}
    assert frequent <= set(summary.at_least(least).tolist())
