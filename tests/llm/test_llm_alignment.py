"""Cross-tokenizer alignment: groups by a plain walk over both ends, whole texts encoded at once."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import alignment, queries
from strata.llm.common import table

SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def paths():
    import public_tokenizers as P
    return P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def whole(paths):
    """text → (groups as lists of ids) by encoding the whole text and walking both sides."""
    import sentencepiece
    from tokenizers import Tokenizer, decoders
    a, b = Tokenizer.from_file(paths[0]), sentencepiece.SentencePieceProcessor(model_file=paths[1])
    a.encode_special_tokens = True
    chars = {c: i for i, c in alignment.byte_characters().items()}
    assert decoders.ByteLevel().decode([chars[65]]) == "A"

    def piece(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()

    def groups(text):
        if not text:
            return None
        x = a.encode(" " + text, add_special_tokens=False)
        y = b.encode(text)
        to_byte = alignment.byte_characters()
        xs, ys = [bytes(map(to_byte.get, t)) for t in x.tokens], [piece(i) for i in y]
        spelled = (" " + text).encode()
        if b"".join(xs) != spelled or b"".join(ys) != spelled:
            return None
        out, i, j, at_a, at_b, left = [], 0, 0, 0, 0, (0, 0)
        while i < len(xs):
            at_a += len(xs[i])
            i += 1
            while at_b < at_a:
                at_b += len(ys[j])
                j += 1
            if at_a == at_b:
                out.append((x.ids[left[0]:i], y[left[1]:j]))
                left = (i, j)
        return out
    return groups


def brute(rows, whole):
    made = [whole(t) for _, t in rows]
    pairs = Counter((a[-1], b[-1]) for g in made for a, b in g or ())
    best = defaultdict(int)
    for (_, b), n in pairs.items():
        best[b] = max(best[b], n)
    out = []
    for (i, _), g in zip(rows, made):
        links = [(a[-1], b[-1]) for a, b in g or ()]
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g or ())
        out.append((i, sum(len(a) for a, _ in g or ()), sum(len(b) for _, b in g or ()), len(links), len(links),
                    sum(pairs[x] == best[x[1]] for x in links), sum(pairs[x] for x in links),
                    hashlib.sha256(text.encode()).hexdigest() if text else ""))
    return sorted(out, key=repr)


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_query_equals_brute_force(spark, whole):
    sf = "/root/testdata/sf0.001"
    got = queries.QUERIES["op12_token_alignment"](spark, sf)
    assert got.columns == COLUMNS
    rows = [tuple(r) for r in table(spark, sf, "documents").select("doc_id", "text").collect()]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows, whole)


def strange_texts(n=600):
    rnd = random.Random(11)
    parts = ["the", "token", " ", "  ", "   ", "\n", "\n\n", "\t", "\r\n", "é", "é", "ﬁ", "日本語", "🙂", "<|endoftext|>",
             "</s>", "<0x0A>", "▁", " ", " ", "\x1c", "'s", "don't", "123", "4.5", "!!", "...", "\x00", "ß", "안녕",
             "​", "A", "B c", " x", "x "]
    return ["".join(rnd.choice(parts) for _ in range(rnd.randrange(1, 14))) for _ in range(n)]


def test_strange_texts_equal_brute_force(spark, paths, whole):
    rows = [(i, t) for i, t in enumerate(strange_texts())]
    got = alignment.align(spark.createDataFrame(rows, SCHEMA).repartition(3), *paths).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows, whole)
    assert any(r.n_a == 0 for r in got) and any(r.n_groups > 3 for r in got)


def test_a_batch_is_many_small_rows(spark, paths, whole):
    rnd = random.Random(5)

    def text(n):
        return " ".join("".join(rnd.choices("abcdeinorst", k=rnd.randrange(3, 9))) for _ in range(n))

    rows = [(i, text(rnd.randrange(300))) for i in range(200)] + [(200, text(2_000)), (201, None), (202, ""), (202, "x")]
    docs = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    parts = alignment.encoded(docs, *paths, keep_groups=True)
    sizes = [sum(len(r[c]) for c in ("chunks", "links", "link_sizes")) + 8 * len(r.pairs) + 8 * len(r.counts)
             for r in parts.collect()]
    assert sum(sizes) > 250_000 and max(sizes) < 150_000
    assert parts.select("batch").distinct().count() == 1
    got = alignment.align(docs, *paths, keep_groups=True).collect()
    assert sorted((tuple(r)[:8] for r in got), key=repr) == brute(rows, whole)
    assert all(hashlib.sha256(r.groups.encode()).hexdigest() == r.groups_sha256 for r in got if r.groups)


def test_staged_rows_lie_in_row_groups_as_asked(spark):
    import pyarrow.parquet as pq
    from strata.llm.common import stage
    staged = stage(spark.range(100_000).coalesce(1), "test-groups", **{"parquet.block.size": "65536"})
    assert pq.ParquetFile(staged.inputFiles()[0].removeprefix("file:")).num_row_groups > 4
    assert staged.count() == 100_000


def test_intervals_without_cuts_are_found_once():
    import numpy as np
    odd, even = np.append(np.arange(1, 200_000, 2), 200_000), np.arange(2, 200_001, 2)
    assert alignment.cut_groups(odd.tolist(), even.tolist()) == [(0, 100_001, 0, 100_000)]


def test_defined_cases(spark, paths, whole):
    long = "ab" * 40_000 + " " + "word " * 20_000
    rows = [(1, None), (2, ""), (3, " "), (4, "a▁b"), (None, "the cat"), (5, "the cat"), (5, "the cat"), (6, long)]
    got = alignment.align(spark.createDataFrame(rows, SCHEMA), *paths, keep_groups=True).collect()
    assert sorted((tuple(r)[:8] for r in got), key=repr) == brute(rows, whole)
    by_id = {r.doc_id: r for r in got}
    assert by_id[1].groups_sha256 == by_id[2].groups_sha256 == by_id[4].groups_sha256 == ""
    assert hashlib.sha256(by_id[5].groups.encode()).hexdigest() == by_id[5].groups_sha256
    assert alignment.align(spark.createDataFrame([], SCHEMA), *paths).collect() == []
    wide = spark.createDataFrame([(1, "the cat", "x", 7)], "doc_id long, text string, pair string, n long")
    assert alignment.align(wide, *paths).first().n_links > 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 3), min_size=1, max_size=90), st.lists(st.integers(1, 3), min_size=1, max_size=90),
       st.sampled_from([1, 2, 5, 4096]))
def test_divide_and_conquer_finds_every_cut(a, b, leaf):
    from itertools import accumulate
    a_ends, b_ends = list(accumulate(a)), list(accumulate(b))
    last = max(a_ends[-1], b_ends[-1])
    for ends in (a_ends, b_ends):
        if ends[-1] < last:
            ends.append(last)
    cuts = sorted(set(a_ends) & set(b_ends))
    want, i, j = [], 0, 0
    for c in cuts:
        x, y = a_ends.index(c) + 1, b_ends.index(c) + 1
        want.append((i, x, j, y))
        i, j = x, y
    assert alignment.cut_groups(a_ends, b_ends, leaf) == want
