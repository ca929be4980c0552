"""Substring dedup against brute force, on repeats at every alignment."""

import hashlib
import random
import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import substrings

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string"


def brute(rows, window):
    words = [WORD.findall(t or "") for _, t in rows]
    seen = Counter(tuple(w[i:i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (i, _), w in zip(rows, words):
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            if seen[tuple(w[s:s + window])] > 1:
                gone[s:s + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def run(spark, rows, window):
    got = substrings.repeats(spark.createDataFrame(rows, SCHEMA), window, keep_text=True).collect()
    for r in got:
        assert hashlib.sha256(r.kept.encode()).hexdigest() == r.kept_sha256
        assert sum(b - a for a, b in zip(r.starts, r.ends)) == r.n_removed
        assert all(b - a >= window for a, b in zip(r.starts, r.ends))
        assert all(b < a for b, a in zip(r.ends, r.starts[1:]))  # neighbours are one repeat
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got), key=repr)


def passages(seed=5, n=120):
    """Documents of random words into which passages of 30 to 45 words are put at any place."""
    rnd = random.Random(seed)
    fresh = lambda k: [rnd.choice("abcdefgh") + str(rnd.randrange(4000)) for _ in range(k)]
    shared = [fresh(k) for k in (30, 34, 35, 36, 45, 80)]
    rows = []
    for i in range(n):
        words = fresh(rnd.randrange(0, 150))
        for _ in range(rnd.randrange(3)):
            at = rnd.randrange(len(words) + 1)
            words[at:at] = rnd.choice(shared)
        rows.append((i, rnd.choice([" ", "\n", "\t "]).join(words)))
    return rows


@pytest.mark.parametrize("window", [35, 6, 7, 1])
def test_repeats_equal_brute_force(spark, window):
    rows = passages()
    assert run(spark, rows, window) == brute(rows, window)


def test_defined_cases(spark):
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "one two"), (None, long), (5, long), (5, long), (6, long + " " + long),
            (7, " ".join(f"w{i}" for i in range(34))), (8, " ".join(["same"] * 200)), (9, " ".join(["same"] * 35)),
            (10, "X" + long[1:]), (11, "tail " + long), (12, " ".join(f"u{i}" for i in range(50000)))]
    assert run(spark, rows, 35) == brute(rows, 35)
    assert run(spark, [(1, " ".join(["a"] * 80))], 35) == brute([(1, " ".join(["a"] * 80))], 35)


def test_empty_table_and_other_columns(spark):
    assert substrings.repeats(spark.createDataFrame([], SCHEMA)).collect() == []
    text = " ".join(f"w{i}" for i in range(40))
    wide = spark.createDataFrame([(1, text, 5, "b"), (2, text, 6, "c")],
                                 "doc_id long, text string, batch long, prints string")
    assert [r.n_removed for r in substrings.repeats(wide).collect()] == [40, 40]


def test_a_large_group_of_copies(spark):
    rows = [(i, " ".join(f"w{j}" for j in range(50)) + f" own{i}") for i in range(3000)]
    got = substrings.repeats(spark.createDataFrame(rows, SCHEMA)).select("n_words", "n_removed").distinct().collect()
    assert [tuple(r) for r in got] == [(51, 50)]


@settings(max_examples=30, deadline=None)
@given(st.lists(st.lists(st.sampled_from("ab"), max_size=12), min_size=1, max_size=4))
def test_functions_without_spark(texts):
    """The passes of one batch and one bucket, called one after the other."""
    import numpy as np
    import pyarrow as pa
    window, rows = 5, [(i, " ".join(t)) for i, t in enumerate(texts)]
    docs = pa.table({"doc_id": [i for i, _ in rows], "text": [t for _, t in rows],
                     "batch": np.zeros(len(rows), np.int64)})
    hits = substrings._match(substrings._probe(window, 1)(docs))
    again = substrings._extend(window, 1)(docs, hits)
    again = substrings._repeated(again) if again.num_rows else again.select(["batch", "bucket", "prints"])
    schema = "doc_id bigint, n_words bigint, n_removed bigint, starts array<bigint>, ends array<bigint>, kept_sha256 string"
    out = substrings._cover(window, 1, schema, False)(docs, again)
    got = sorted(zip(*(out.column(c).to_pylist() for c in ("doc_id", "n_words", "n_removed", "kept_sha256"))), key=repr)
    assert got == brute(rows, window)
