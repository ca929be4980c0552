"""Operators on documents against brute force, and on awkward rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from tests_llm_helpers import components

from strata.llm import bpe, curriculum, exact_dedup, hamming_dedup, hpylm, queries, sharding, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, size int, mix string"
WORD = re.compile(rb"[^\x20\x09-\x0d]+")
SPACE = re.compile("[\x20\x09-\x0d]+")


def frame(spark, texts, sources=None):
    """Documents 0, 1, … with further columns whose names the operators use themselves."""
    rows = [(i, t, "en", (sources or ["a"] * len(texts))[i], 1, f"x{i}", i, "m") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def awkward(spark):
    """Null texts, ids and sources, empty and blank texts, repeated rows, ties, a long text."""
    long = " ".join(f"word{i % 700}" for i in range(60_000))
    rows = [(1, None, None, None, None, None, None, None), (2, "", "en", "b", 0, "q", 1, ""),
            (3, " \t\n", "en", "b", 3, "q", 1, ""), (4, "one two three", "en", None, 1, "q", 1, ""),
            (4, "one two three", "en", None, 1, "q", 1, ""), (5, "one  two three", "en", "c", 1, "q", 1, ""),
            (None, "one two three", "en", "c", 1, "q", 1, ""), (None, None, "en", "c", 1, "q", 1, ""),
            (6, long, "en", "c", 1, "q", 1, ""), (7, long + " tail", "en", "", 1, "q", 1, ""),
            (2 ** 53 + 1, "é中\U0001f600 <|endoftext|> x", "en", "d", 1, "q", 1, ""), (6, "other text of six", "en", "c", 1, "q", 1, "")]
    return spark.createDataFrame(rows, SCHEMA)


def shingles(text, k):
    w = WORD.findall((text or "").encode().lower())
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


# --- exact dedup -----------------------------------------------------------------------------

def test_exact_dedup_decisions(spark):
    out = exact_dedup.new_index(spark).admit(awkward(spark)).collect()
    assert len(out) == 12
    by = defaultdict(list)
    for r in out:
        by[r.text_sha256].append(r)
    empty = by[hashlib.sha256(b"").hexdigest()]
    assert {r.keep_id for r in empty} == {3} and len(empty) == 4  # the blank text is the longest
    same = by[hashlib.sha256(b"onetwothree").hexdigest()]
    assert {r.keep_id for r in same} == {5} and {r.group_size for r in same} == {4}
    assert [r.doc_id for r in same if r.kept] == [5]


def test_exact_dedup_index_persists(spark):
    index = exact_dedup.new_index(spark)
    index.admit(frame(spark, ["a b", "c", "ab"])).collect()
    again = exact_dedup.DigestIndex(spark, index.path, index.buckets)
    out = {r.doc_id: r for r in again.admit(frame(spark, ["new", "a  b ", "a b"])).collect()}
    assert out[0].kept and not out[1].kept and out[1].keep_id == 0 and out[1].group_size == 4
    assert again.rows().count() == 3  # "ab", "c", "new"
    plan = again.rows()._jdf.queryExecution().toString()
    assert "Bucketed: true" in plan or "bucket" in plan.lower()
    assert index.admit(frame(spark, [])).count() == 0


def test_group_sizes_count_all_batches(spark):
    index = exact_dedup.new_index(spark)
    sizes = []
    for first, n in ((0, 2), (10, 3), (20, 4), (30, 1)):
        docs = spark.createDataFrame([(first + i, "same text" + " " * i) for i in range(n)] + [(first + 9, f"own {first}")],
                                     "doc_id long, text string")
        out = {r.doc_id: r for r in index.admit(docs).collect()}
        sizes.append(out[first].group_size)
        assert {r.keep_id for r in out.values() if r.doc_id != first + 9} == {1}
        assert out[first + 9].kept and out[first + 9].group_size == 1
        assert sum(r.kept for r in out.values()) == (2 if first == 0 else 1)
    assert sizes == [2, 5, 9, 10]
    assert {r.group_size for r in index.rows().collect()} == {10, 1} and index.rows().count() == 5
    assert "Exchange" not in index.rows()._jdf.queryExecution().executedPlan().toString()


def test_exact_dedup_keeps_one_row_and_its_columns(spark):
    docs = awkward(spark)
    out = exact_dedup.keep_first(docs, exact_dedup.new_index(spark).admit(docs))
    assert out.columns == docs.columns
    texts = Counter(SPACE.sub("", r.text or "") for r in out.collect())
    assert set(texts.values()) == {1} and len(texts) == 6


def test_exact_dedup_third_of_rows_equal(spark):
    rng = random.Random(3)
    texts = ["hot  text" if i % 3 == 0 else f"t{rng.randrange(400)}" for i in range(900)]
    out = exact_dedup.new_index(spark).admit(frame(spark, texts)).collect()
    groups = defaultdict(list)
    for i, t in enumerate(texts):
        groups[SPACE.sub("", t)].append((-len(t), i))
    want = {i: (min(g)[1], len(g)) for g in groups.values() for _, i in g}
    assert {r.doc_id: (r.keep_id, r.group_size) for r in out} == want


# --- near dedup ------------------------------------------------------------------------------

def near_corpus(seed=5, groups=30):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    texts = ["", None, "solo", "Solo", "two words", "two  words"]
    for _ in range(groups):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(20, 160))]
        for _ in range(rng.randint(1, 8)):
            copy = [rng.choice(vocabulary) if rng.random() < rng.choice([0.0, 0.02, 0.05, 0.08]) else w for w in base]
            texts.append(" ".join(copy))
    return texts


@pytest.mark.parametrize("size", [2, 5])
def test_near_dedup_equals_brute_force(spark, size):
    texts = near_corpus(groups=25)
    sets = [shingles(t, size) for t in texts]
    links = [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and sets[j]
             and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    want = components(links, range(len(texts)))
    docs = frame(spark, texts)
    out = {r.doc_id: r for r in hamming_dedup.link(docs, size).collect()}
    assert {i: r.component_id for i, r in out.items()} == want
    assert all(out[i].n_shingles == len(s) and out[i].kept == (want[i] == i) for i, s in enumerate(sets))
    kept = hamming_dedup.keep_one(docs, size)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i in want if want[i] == i)


def test_near_dedup_awkward_rows(spark):
    docs = awkward(spark)
    out = hamming_dedup.link(docs).collect()
    assert len(out) == 12
    assert all(r.component_id == r.doc_id and r.n_shingles == 0 for r in out if r.doc_id in (1, 2, 3))
    assert {r.component_id for r in out if r.doc_id in (4, 5)} == {4}
    # Both long texts; the other document 6 is a component of its own.
    assert sorted(r.component_id for r in out if r.doc_id in (6, 7)) == [6, 6, 6]
    assert Counter(r.doc_id for r in hamming_dedup.keep_one(docs).collect()) == Counter(
        [1, 2, 3, 4, None, 6, 6, 2 ** 53 + 1])
    assert hamming_dedup.link(frame(spark, [])).count() == 0


def test_signature_join_is_exact_under_its_threshold():
    import numpy as np
    rng = np.random.default_rng(1)
    one = rng.integers(0, 256, (200, hamming_dedup.VALUES), dtype=np.uint8)
    limit = hamming_dedup.CHUNKS * (hamming_dedup.ERRORS + 1) - 1
    two = one.copy()
    for row in two:
        row[rng.choice(hamming_dedup.VALUES, limit, replace=False)] ^= 1
    a, b = hamming_dedup.signature_keys(one), hamming_dedup.signature_keys(two)
    assert ((a == b).any(axis=1)).all()


# --- mixing ----------------------------------------------------------------------------------

def test_mix_reaches_targets(spark):
    rng = random.Random(2)
    texts = ["x " * rng.randint(0, 300) for _ in range(600)]
    sources = [rng.choice(["a"] * 8 + ["b", "c", "d", None]) for _ in texts]
    out = curriculum.assignments(frame(spark, texts, sources)).collect()
    assert len(out) == len(texts)
    taken, target, size = Counter(), {}, Counter()
    for r in out:
        s = sources[r.doc_id]
        assert 0 <= r.taken <= 3 * r.size and r.size == len(texts[r.doc_id].split())
        taken[s] += r.taken
        size[s] += r.size
        target[s] = r.target
    weights = dict(zip(["a", "b", "c", "d", None], [5, 2, 1, 5, 2]))
    share, capped = {}, set()
    while True:  # repeated re-sharing
        left = sum(size.values()) - sum(3 * size[s] for s in capped)
        free = sum(w for s, w in weights.items() if s not in capped)
        share = {s: 3 * size[s] if s in capped else left * w / free for s, w in weights.items()}
        more = {s for s in weights if share[s] > 3 * size[s]} - capped
        if not more:
            break
        capped |= more
    assert target == pytest.approx(share)
    assert all(abs(taken[s] - share[s]) <= 1 for s in share)


def test_mix_positions_follow_the_schedules(spark):
    texts = ["x " * 50] * 400
    docs = frame(spark, texts, ["a", "b", "c", "d"] * 100)
    rows = curriculum.assign(docs).select("source", "_mix.positions").collect()
    mean = {s: (lambda p: sum(p) / len(p))([x for r in rows if r.source == s for x in r.positions]) for s in "abc"}
    assert mean["a"] < 0.45 < mean["b"] < 0.55 < mean["c"]  # early, even and late sources
    assert all(0 <= x <= 1 for r in rows for x in r.positions)


def test_mix_awkward_rows_and_columns(spark):
    docs = awkward(spark)
    out = curriculum.assignments(docs).collect()
    assert len(out) == 12 and all(r.taken == 0 for r in out if r.size == 0)
    assert curriculum.assignments(docs).collect() == out  # reruns agree
    mixed = curriculum.mixed(docs)
    assert mixed.columns == docs.columns
    originals = Counter(map(tuple, docs.collect()))
    assert all(n <= 3 * originals[r] for r, n in Counter(map(tuple, mixed.collect())).items())
    assert curriculum.assignments(frame(spark, [])).count() == 0


# --- sharding --------------------------------------------------------------------------------

def test_lookup_table_is_full_and_even():
    table = sharding.lookup_table()
    counts = Counter(table)
    assert len(table) == sharding.SLOTS and set(counts) == set(range(sharding.SHARDS))
    assert max(counts.values()) - min(counts.values()) <= 1
    fewer = sharding.lookup_table(sharding.SHARDS - 1)
    moved = sum(a != b for a, b in zip(table, fewer) if a != sharding.SHARDS - 1)
    assert moved < 0.1 * len(table)
    with pytest.raises(ValueError):
        sharding.lookup_table(4, 100)


def test_place_awkward_rows(spark, tmp):
    docs = awkward(spark).withColumnRenamed("mix", "shard")
    out = sharding.place(docs).collect()
    assert len(out) == 12
    assert len({r.shard for r in out if r.doc_id == 4}) == 1
    assert all(0 <= r.shard < sharding.SHARDS for r in out)
    sharding.write_shards(docs, tmp)
    assert spark.read.parquet(tmp).count() == 12
    assert sharding.place(frame(spark, [])).count() == 0


# --- tokens ----------------------------------------------------------------------------------

def tiktoken_encoding():
    import base64

    import public_tokenizers as P
    import tiktoken
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_tiktoken():
    ours, other, rng = bpe.ByteBPE(queries.tokenizer_file()), tiktoken_encoding(), random.Random(1)
    pool = " \n\t\r\x0b\x0c\x1c\x85 　​aAé'sdtm1٣½Ⅷ漢\U0001f600.,!<|\x00"
    texts = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    texts += ["", "<|endoftext|>", "  lead", "a" * 5000, "漢" * 3000, "x \n y  z\n\n"]
    for text, ids in zip(texts, ours.encode(texts)):
        assert ids.tolist() == other.encode_ordinary(text)
        assert ours.decode(ids.tolist()).decode() == text


def test_bpe_offsets_and_stream():
    ours = bpe.ByteBPE(queries.tokenizer_file())
    text = "naïve \U0001f600中文 ok"
    ids, spans = ours.encode_with_offsets(text)
    assert ids.tolist() == ours.encode([text])[0].tolist()
    assert spans[0][0] == 0 and spans[-1][1] == len(text) and all(a < b for a, b in spans)
    for i, (a, b) in zip(ids, spans):
        assert ours.table[i] in text[a:b].encode()
    step = ours.stream_decoder()
    assert "".join(step(i) for i in ids) + step(None, True) == text


def test_bpe_frames(spark):
    docs = awkward(spark).withColumnRenamed("id", "ids")
    out = bpe.round_trip(docs, queries.tokenizer_file()).collect()
    assert len(out) == 12 and all(r.n_tokens == 0 for r in out if r.doc_id in (1, 2))
    wanted = sorted(hashlib.sha256((r.text or "").encode()).hexdigest() for r in docs.collect())
    assert sorted(r.decoded_sha256 for r in out) == wanted
    encoded = bpe.encode(docs, queries.tokenizer_file(), offsets=True)
    back = bpe.decode(encoded, queries.tokenizer_file()).collect()
    assert sorted(bytes(r.decoded) for r in back) == sorted((r.text or "").encode() for r in docs.collect())
    assert all(len(r.ids) == r.n_tokens == len(r.starts) for r in back)
    assert bpe.encode(frame(spark, []), queries.tokenizer_file()).count() == 0


# --- toxicity --------------------------------------------------------------------------------

def toxic_corpus(spark, n=1200):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(400)]
    bad = ["wretch", "foulmouth", "vilelu", "vileka", "vilemo"]
    texts, labels = [], []
    for i in range(n):
        grade = 0 if i % 5 else 1 + (i % 10 == 0)
        body = [rng.choice(words) for _ in range(rng.randint(5, 80))]
        for _ in range(0 if not grade else rng.randint(2, 4) * grade):
            body.insert(rng.randrange(len(body)), rng.choice(bad))
        texts.append(" ".join(body))
        labels.append((i, 0 if grade == 2 else 1, int(grade > 0)))
    return texts, labels


def test_toxicity_on_held_out_rows(spark):
    texts, labels = toxic_corpus(spark)
    docs = frame(spark, texts)
    known = spark.createDataFrame([x for x in labels if x[0] % 3], "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, known)
    assert model.thetas == sorted(model.thetas) and "vile-" in model.weights
    out = {r.doc_id: r.toxicity for r in toxicity.score(docs, model).collect()}
    held = [x for x in labels if not x[0] % 3]
    assert sum(out[i].rejected == bool(t) for i, _, t in held) >= 0.97 * len(held)
    grade = lambda g: [out[i].severity for i, q, t in held if (0 if not t else 2 - q) == g]
    means = [sum(grade(g)) / len(grade(g)) for g in range(3)]
    assert means[0] < 0.2 < 0.8 < means[1] < means[2]


def test_toxicity_awkward_rows(spark):
    docs = awkward(spark)
    labels = spark.createDataFrame([(None, 1, 1), (1, None, None), (4, None, 1), (4, 0, 1), (99, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    out = toxicity.score(docs, toxicity.train(docs, labels)).collect()
    assert len(out) == 12 and not any(r.toxicity.rejected for r in out if not r.text)
    none = toxicity.train(docs, labels.limit(0))
    assert not any(r.toxicity.rejected for r in toxicity.score(docs, none).collect())
    assert toxicity.score(frame(spark, []), none).count() == 0


def test_ordinal_gradient_finds_thresholds():
    import numpy as np
    rng = np.random.default_rng(0)
    x = rng.integers(0, 2, (3000, 3))
    score = x @ np.array([2.0, -1.0, 0.5])
    noise = rng.logistic(size=3000)
    grades = (score + noise > 0.5).astype(int) + (score + noise > 2.5)
    rows, cols = np.nonzero(x)
    w, theta = toxicity.fit_ordinal(rows, cols, grades, 3, ridge=1e-3)
    assert np.allclose(w, [2.0, -1.0, 0.5], atol=0.3) and np.allclose(theta, [0.5, 2.5], atol=0.3)


# --- language model --------------------------------------------------------------------------

def lm_brute(rows):
    toks = [(i, WORD.findall((t or "").encode().lower()) + [None]) for i, t in rows]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    counts = Counter(w for i, ws in toks if not held(i) for w in ws)
    n, v = sum(counts.values()), len(counts)
    return sorted(((i is None, i or 0), held(i), len(ws), sum(counts[w] > 0 for w in ws), n, round(sum(
        math.log10((counts[w] + 1) / (n + v + 1)) for w in ws), 6)) for i, ws in toks)


def test_language_model_counts_and_base(spark):
    docs = awkward(spark)
    out = hpylm.score(docs).collect()
    got = sorted(((r.doc_id is None, r.doc_id or 0), r.held_out, r.n_tokens, r.n_known, r.train_tokens,
                  round(r.base_score, 6)) for r in out)
    assert got == lm_brute([(r.doc_id, r.text) for r in docs.collect()])
    assert all(math.isfinite(r.score) and r.score < 0 for r in out)
    assert hpylm.score(frame(spark, [])).count() == 0


def test_language_model_learns_contexts(spark):
    rng = random.Random(4)
    chain = {f"w{i}": [f"w{rng.randrange(60)}" for _ in range(3)] for i in range(60)}
    texts = []
    for _ in range(400):
        w = [f"w{rng.randrange(60)}"]
        while len(w) < 40:
            w.append(rng.choice(chain[w[-1]]))
        texts.append(" ".join(w))
    docs = frame(spark, texts)
    out = hpylm.score(docs).collect()
    held = [r for r in out if r.held_out]
    ppl = lambda c: 10 ** (-sum(r[c] for r in held) / sum(r.n_tokens for r in held))
    assert ppl("score") < 6 < 0.2 * ppl("base_score")
    assert sorted((r.doc_id, r.score) for r in hpylm.score(docs).collect()) == sorted(
        (r.doc_id, r.score) for r in out)  # seeded: reruns agree


def test_language_model_keeps_contexts_apart(spark):
    rng = random.Random(8)
    n = 20_000  # several words for each of the 4,096 restaurants that contexts were once hashed to
    follows = list(range(n))
    rng.shuffle(follows)
    texts = []
    for _ in range(1000):
        w = [rng.randrange(n)]
        while len(w) < 400:
            w.append(follows[w[-1]])
        texts.append(" ".join(f"w{x}" for x in w))
    held = [r for r in hpylm.score(frame(spark, texts)).collect() if r.held_out]
    assert 10 ** (-sum(r.score for r in held) / sum(r.n_tokens for r in held)) < 2


def test_predictive_probabilities_sum_to_one():
    import numpy as np
    rng = np.random.default_rng(2)
    v, n_contexts = 12, hpylm.CONTEXTS + 1
    words = np.sort(rng.integers(1, 2 ** 63, v).astype(np.uint64))
    count = rng.integers(0, 9, (v, 3))
    count[:, 0] += 1
    customers = np.zeros(n_contexts)
    customers[:3] = count.sum(axis=0)
    corpus = hpylm.Corpus(int(count.sum()), v, customers, np.zeros(0, np.uint64), np.zeros(0), 0.6, 0.4)
    bucket = hpylm.Bucket(0, hpylm._pack(words, np.full(v, 3), np.tile(np.arange(3), v), count.ravel()), corpus)

    def totals(tables_1):
        tables = np.bincount(bucket.context, bucket.tables, n_contexts)
        return hpylm.Totals(tables, float(tables.sum()), float(tables_1.sum()))
    history = [totals(np.ones(v))]
    for tables_1 in bucket.replay(history):
        pass
    now = totals(tables_1)
    p = bucket.predictive(now, tables_1).reshape(v, 3)
    unknown = (1 + 0.4 * now.tables_1) / (v + 1) / (1 + now.customers_1) * (1 + 0.6 * now.tables[:3]) / (1 + customers[:3])
    assert np.allclose(p.sum(axis=0) + unknown, 1)
