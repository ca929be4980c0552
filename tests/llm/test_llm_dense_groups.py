"""Near duplicates in a dense group: most pairs between similarity 0.6 and 0.8, few links."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from tests_llm_helpers import components

from strata.llm import hamming_dedup


def pairs_of(sets, percent=80):
    ids = sorted(sets)
    return [(a, b) for i, a in enumerate(ids) for b in ids[i + 1:]
            if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]


def dense(n=400, words=120, changed=3, seed=2):
    rnd = random.Random(seed)
    base = [f"w{rnd.randrange(10**6)}" for _ in range(words)]
    texts = []
    for i in range(n):
        text = list(base)
        for k in rnd.sample(range(words), changed + rnd.randrange(6)):
            text[k] = f"x{rnd.randrange(10**6)}"
        texts.append(" ".join(text[:words - rnd.randrange(8)]))
    return texts


def test_dense_group_equals_brute_force(spark):
    texts = dense()
    sets = {}
    for i, t in enumerate(texts):
        w = t.split()
        sets[i] = {tuple(w[k:k + 2]) for k in range(len(w) - 1)}
    similarity = Counter(round(len(sets[a] & sets[b]) / len(sets[a] | sets[b]), 1) for a in range(0, 400, 7) for b in range(a))
    assert sum(n for s, n in similarity.items() if .6 <= s <= .8) > .6 * sum(similarity.values())
    links = pairs_of(sets)
    want = components(links, sets)
    assert 5 < len(set(want.values())) < 390  # neither one component nor all apart
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = {r.doc_id: r.component_id for r in hamming_dedup.link(docs).collect()}
    assert got == want


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.sets(st.integers(0, 9), min_size=1, max_size=9), st.integers(0, 4), st.integers(0, 1)),
                min_size=1, max_size=12), st.sampled_from([50, 80]))
def test_forest_of_a_meeting(rows, percent):
    """All links between the two sides (or inside the only one) are implied by the forest."""
    lists = pa.array([sorted(s) for s, _, _ in rows], pa.list_(pa.int64()))
    side = np.array([s for _, _, s in rows])
    if not (side == 0).any():
        side[:] = 0
    label = np.array([c for _, c, _ in rows])
    ids = np.arange(100, 100 + len(rows))
    a, b = hamming_dedup._forest(ids, label, side, lists, percent)
    assert len(a) < max(len(rows), 2)
    sets = {int(i): s for i, (s, _, _) in zip(ids, rows)}
    linked = {tuple(sorted(p)) for p in pairs_of(sets, percent)}
    assert all(tuple(sorted(p)) in linked for p in zip(a, b))
    two = (side == 1).any()
    crossing = [p for p in linked if not two or side[p[0] - 100] != side[p[1] - 100]]
    inside = [(int(x), int(y)) for x in ids for y in ids if x < y and label[x - 100] == label[y - 100]]
    everyone = [int(i) for i in ids]
    assert components(inside + list(zip(a, b)), everyone) == components(inside + crossing, everyone)
