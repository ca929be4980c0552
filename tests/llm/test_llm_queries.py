"""The registered queries on sf0.001: against DuckDB where there is SQL, else against brute force;
and the pipeline, every stage judged on its own input."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
from tests_llm_helpers import components

import __spark_entry__ as entry
import corpus_pipeline
from strata.llm import queries
from strata.llm.common import stage, table
from tools.oracle_check import TABLES, digest

SF = "/root/testdata/sf0.001"
WORD = re.compile(rb"[^\x20\x09-\x0d]+")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.fixture(scope="module")
def encoding():
    import base64

    import public_tokenizers as P
    import tiktoken
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_thirteen_queries_and_the_pipeline_are_registered():
    names = [n for n in entry.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(re.match(r"op(\d+)", n)[1]) for n in names) == list(range(1, 14))
    assert entry.queries()["pipeline"] is corpus_pipeline.run


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = queries.QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(queries.ORACLE[name])
    cols, want = [d[0] for d in cur.description], cur.fetchall()
    assert sorted(df.columns) == sorted(cols) and len(rows) == len(want)
    assert digest(df.columns, rows)[0] == digest(cols, want)[0]


@pytest.mark.parametrize("name", ["op6_exact_dedup", "op8_curriculum_mix", "op10_shard_table"])
def test_native_queries_run_no_python(spark, name):
    plan = queries.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_bpe_query_equals_tiktoken(spark, con, encoding):
    out = {r.doc_id: r for r in queries.op7_byte_bpe(spark, SF).collect()}
    rows = con.execute("SELECT doc_id, text FROM documents").fetchall()
    assert len(out) == len(rows)
    for i, text in rows:
        ids = encoding.encode_ordinary(text)
        packed = b"".join(x.to_bytes(4, "little") for x in ids)
        assert (out[i].n_tokens, out[i].ids_sha256, out[i].decoded_sha256) == (
            len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def test_language_model_query(spark, con):
    out = {r.doc_id: r for r in queries.op2_pitman_yor(spark, SF).collect()}
    toks = {i: WORD.findall(t.encode().lower()) + [None]
            for i, t in con.execute("SELECT doc_id, text FROM documents").fetchall()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in toks}
    counts = Counter(w for i, ws in toks.items() if not held[i] for w in ws)
    n, v = sum(counts.values()), len(counts)
    for i, ws in toks.items():
        r = out[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (
            held[i], len(ws), sum(counts[w] > 0 for w in ws), n)
        assert math.isclose(r.base_score, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws), rel_tol=1e-9)
    unseen = [i for i in toks if held[i]]
    assert sum(out[i].score for i in unseen) > sum(out[i].base_score for i in unseen)


def test_toxicity_query(spark, con):
    out = {r.doc_id: r for r in queries.op5_toxicity(spark, SF).collect()}
    assert len(out) == 200 and all(0 <= r.severity <= 2 and 0 <= r.p_toxic <= 1 for r in out.values())
    labels = con.execute("SELECT doc_id, toxic FROM labels").fetchall()
    assert sum(out[i].rejected == bool(t) for i, t in labels) >= 0.9 * len(labels)


def test_html_query_keeps_articles(spark, con):
    out = {r.page_id: r for r in queries.op4_html_text(spark, SF).collect()}
    import html as refs
    for i, page in con.execute("SELECT page_id, html FROM pages").fetchall():
        article = re.search(r"<article>(.*?)</article>", page, re.S)[1]
        blocks = (" ".join(refs.unescape(re.sub("<[^>]*>", "", b.replace("<br>", " "))).split())
                  for b in re.split("</?(?:p|h1)>", article))
        assert out[i].text == "\n".join(b for b in blocks if b) and out[i].n_chars == len(out[i].text)


def test_pipeline_stages(spark, encoding):
    docs = table(spark, SF, "documents")
    steps = {}
    for name, function in corpus_pipeline.STAGES:
        out = stage(function(spark, docs, SF), f"test-{name}")
        steps[name] = (docs, out)
        if name != "bpe":
            assert out.columns == docs.columns
        docs = out
    read = lambda df: {r.doc_id: r for r in df.collect()}

    before, after = (read(d) for d in steps["toxicity"])
    toxic = {r.doc_id for r in queries.op5_toxicity(spark, SF).where("rejected").collect()}
    assert set(after) == set(before) - toxic

    before, after = (read(d) for d in steps["exact_dedup"])
    groups = defaultdict(list)
    for r in before.values():
        groups[re.sub("[\x20\x09-\x0d]", "", r.text)].append((-len(r.text), r.doc_id))
    assert set(after) == {min(g)[1] for g in groups.values()}

    before, after = (read(d) for d in steps["near_dedup"])
    sets = {}
    for i, r in before.items():
        w = WORD.findall(r.text.encode().lower())
        sets[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    ids = sorted(sets)
    links = [(a, b) for a in ids for b in ids if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    parts = components(links, ids)
    assert set(after) == {i for i in ids if parts[i] == i}

    rows = steps["mixing"][1].collect()
    before = read(steps["mixing"][0])
    times = Counter(r.doc_id for r in rows)
    assert all(n <= 3 and i in before for i, n in times.items())
    assert all(before[r.doc_id] == r for r in rows)
    total = sum(len(WORD.findall(r.text.encode())) for r in before.values())
    mixed = sum(len(WORD.findall(r.text.encode())) for r in rows)
    longest = max(len(WORD.findall(r.text.encode())) for r in before.values())
    assert abs(mixed - total) <= 10 * longest

    out = steps["bpe"][1].collect()
    assert len(out) == len(rows)
    assert all(list(r.ids) == encoding.encode_ordinary(before[r.doc_id].text) for r in out)


def test_pipeline_awkward_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, id string, _x int"
    rows = [(1, None, None, None, None, None, None), (2, "", "en", "b", 0, "q", 1), (3, "a b c", "en", "b", 1, "q", 1),
            (3, "a b c", "en", "b", 1, "q", 1), (None, "a  b c", "en", "c", 1, "q", 1), (4, "z " * 20_000, "en", "c", 1, "q", 1),
            (5, "other words in a text of its own", "en", "", 1, "q", 1)]
    for data in (rows, []):
        docs = spark.createDataFrame(data, schema)
        for name, function in corpus_pipeline.STAGES:
            out = stage(function(spark, docs, SF), f"odd-{name}")
            if name != "bpe":
                assert out.columns == docs.columns
            if name == "near_dedup" and data:
                assert {r.doc_id for r in out.collect() if r.text} == {None, 4, 5}  # of the copies the longest
            docs = out
        assert (docs.count() > 0) == bool(data)
