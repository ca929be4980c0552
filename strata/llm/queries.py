"""Registered queries of this subpackage, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strata.llm import (alignment, bpe, curriculum, exact_dedup, hamming_dedup, hpylm, html_text, phrases, pq_dedup,
                        sharding, substrings, toxicity, warc)
from strata.llm.common import table
from strata.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE[fn.__name__] = sql
        return fn
    return register


@query(r"""
WITH RECURSIVE
e AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v,
         embedding IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
         AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
         AND len([x FOR x IN embedding IF x <> 0]) > 0 AS usable
  FROM embeddings),
u AS (SELECT vec_id, label, v FROM e WHERE usable),
l AS (
  SELECT a.vec_id AS a, b.vec_id AS b
  FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.93),
r(id, other) AS (
  SELECT a, b FROM l
  UNION
  SELECT r.id, l.b FROM r JOIN l ON r.other = l.a),
c AS (SELECT id, least(id, min(other)) AS component_id FROM r GROUP BY id),
n AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
SELECT e.vec_id, coalesce(n_links, 0) AS n_links, coalesce(component_id, e.vec_id) AS component_id,
       coalesce(component_id, e.vec_id) = e.vec_id AS kept
FROM e LEFT JOIN n ON e.vec_id = n.a LEFT JOIN c ON e.vec_id = c.id
""")
def op1_pq_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Linked embeddings of each label, their components and the vectors that stay."""
    return pq_dedup.link(table(spark, sf_dir, "embeddings"))


@query()
def op2_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by the model learned from those that are not held out."""
    return hpylm.score(table(spark, sf_dir, "documents"))


@query(r"""
WITH RECURSIVE
w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                              'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 1 THEN [ws[1]]
                                      ELSE [ws[i] || ' ' || ws[i + 1] FOR i IN range(1, len(ws))] END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
x AS (SELECT doc_id, list(g ORDER BY g) AS gs FROM s GROUP BY doc_id),
f AS (SELECT gs, min(doc_id) AS rep FROM x GROUP BY gs),
m AS (SELECT x.doc_id, f.rep FROM x JOIN f USING (gs)),
k AS (
  SELECT s.doc_id, s.g, n.n, row_number() OVER (PARTITION BY s.doc_id ORDER BY q.c, s.g) AS r
  FROM s JOIN n USING (doc_id) JOIN (SELECT g, count(*) AS c FROM s GROUP BY g) q USING (g)
  WHERE s.doc_id IN (SELECT rep FROM f)),
p AS (SELECT * FROM k WHERE r <= n - ceil(0.8 * n) + 1),
c AS (
  SELECT DISTINCT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb
  FROM p a JOIN p b ON a.g = b.g AND a.doc_id < b.doc_id AND least(a.n, b.n) * 100 >= greatest(a.n, b.n) * 80),
i AS (
  SELECT c.a, c.b, c.na, c.nb, count(*) AS shared
  FROM c JOIN s sa ON sa.doc_id = c.a JOIN s sb ON sb.doc_id = c.b AND sb.g = sa.g GROUP BY ALL),
l AS (
  SELECT a, b FROM i WHERE 100 * shared >= 80 * (na + nb - shared)
  UNION ALL SELECT rep, doc_id FROM m WHERE rep <> doc_id),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
t(id, other) AS (SELECT a, b FROM e UNION SELECT t.id, e.b FROM t JOIN e ON t.other = e.a),
d AS (SELECT id, least(id, min(other)) AS component_id FROM t GROUP BY id)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(d.component_id, w.doc_id) AS component_id,
       coalesce(d.component_id, w.doc_id) = w.doc_id AS kept
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN d ON d.id = w.doc_id
""")
def op3_hamming_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return hamming_dedup.link(table(spark, sf_dir, "documents"))


@query()
def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extract_pages(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


@query()
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Severity of every document by the model fitted on the labelled ones."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs.select("doc_id", "text"), model).select("doc_id", "toxicity.*")


@query(r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents),
g AS (
  SELECT text_sha256, count(*) AS group_size,
         arg_min(doc_id, row(-n, doc_id)) AS keep_id
  FROM d GROUP BY text_sha256)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, d.text_sha256
FROM d JOIN g USING (text_sha256)
""")
def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents admitted to an empty digest index; one row per document."""
    index = exact_dedup.new_index(spark)
    return index.admit(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


def tokenizer_file() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


@query()
def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again."""
    return bpe.round_trip(table(spark, sf_dir, "documents"), tokenizer_file())


@query(r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')) AS k
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (
  SELECT *, [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight FROM s),
f AS (
  SELECT *, source_size::DOUBLE / weight AS fill FROM w),
c AS (
  SELECT *, (sum(source_size) OVER () - sum(3 * source_size) OVER ()
             + sum(3 * source_size) OVER (ORDER BY fill RANGE BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS room,
         sum(weight) OVER (ORDER BY fill RANGE BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS room_weight
  FROM f),
l AS (
  SELECT *, 3 * source_size * room_weight >= room * weight AS free FROM c),
t AS (
  SELECT l.source, l.source_size,
         CASE WHEN l.free THEN (v.room * l.weight)::DOUBLE / v.room_weight::DOUBLE
              ELSE (3 * l.source_size)::DOUBLE END AS target
  FROM l LEFT JOIN (SELECT room, room_weight FROM l WHERE free ORDER BY fill LIMIT 1) v ON true),
p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, round(t.target)::BIGINT AS budget,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - d.size AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (greatest(0, least(size, budget - start))
        + greatest(0, least(size, budget - start - source_size))
        + greatest(0, least(size, budget - start - 2 * source_size)))::BIGINT AS taken
FROM p
""")
def op8_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to the weights of their sources, in order of training position."""
    return curriculum.assignments(table(spark, sf_dir, "documents"))


@query(r"""
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT h, min(page_id) AS first_id FROM p GROUP BY h)
SELECT page_id, payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                               1 + ((('0x' || substr(h, 1 + 10 * (i // 8), 10))::BIGINT >> (35 - 5 * (i % 8))) & 31)::INT, 1)
                        FOR i IN range(32)], '') AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS NOT DISTINCT FROM first_id THEN NULL ELSE first_id END AS refers_to
FROM p JOIN f USING (h)
""")
def op9_warc_zstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to Zstandard WARC archives and read back."""
    path = scratch_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    return warc.read_archives(spark, path).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query(r"""
WITH RECURSIVE
pref AS (
  SELECT s, (('0x' || substr(md5('offset-' || s), 1, 14))::BIGINT) % 3203 AS off,
         (('0x' || substr(md5('step-' || s), 1, 14))::BIGINT) % 3202 + 1 AS step
  FROM range(32) r(s)),
fill(turn, owner) AS (
  SELECT 0::BIGINT, [-1 FOR x IN range(3203)]
  UNION ALL
  SELECT turn + 1, owner[1:slot] || [s::INTEGER] || owner[slot + 2:]
  FROM (SELECT turn, owner, s,
               [z FOR z IN [(off + j * step) % 3203 FOR j IN range(3203)] IF owner[z + 1] = -1][1] AS slot
        FROM fill JOIN pref ON s = turn % 32 WHERE turn < 3203)),
filled AS (SELECT owner FROM fill WHERE turn = 3203),
placed AS (
  SELECT doc_id, (('0x' || substr(md5(coalesce(doc_id::VARCHAR, 't' || coalesce(text, ''))), 1, 14))::BIGINT)
         % 3203 AS slot
  FROM documents)
SELECT doc_id, slot::INTEGER AS slot, owner[slot + 1]::INTEGER AS shard FROM placed, filled
""")
def op10_shard_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shard of every document."""
    return sharding.place(table(spark, sf_dir, "documents")).select("doc_id", "slot", "shard")


@query(r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
s AS (
  SELECT r, p, md5(array_to_string(ws[p:p + 34], ' ')) AS h
  FROM (SELECT r, ws, unnest(range(1, len(ws) - 33)) AS p FROM w WHERE len(ws) >= 35)),
x AS (SELECT r, p FROM s WHERE h IN (SELECT h FROM s GROUP BY h HAVING count(*) > 1)),
o AS (SELECT r, doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM w),
m AS (
  SELECT o.r, o.word, o.p,
         max(CASE WHEN x.p IS NOT NULL THEN o.p END)
           OVER (PARTITION BY o.r ORDER BY o.p ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) IS NOT NULL AS gone
  FROM o LEFT JOIN x ON x.r = o.r AND x.p = o.p),
k AS (
  SELECT r, sum(gone::INT)::BIGINT AS n_removed,
         coalesce(string_agg(word, ' ' ORDER BY p) FILTER (NOT gone), '') AS kept
  FROM m GROUP BY r)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN k USING (r)
""")
def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents that lie in a passage of 35 words found elsewhere."""
    return substrings.repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", "kept_sha256")


@query()
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links between the byte-level and the SentencePiece tokens of every document."""
    import public_tokenizers
    return alignment.align(table(spark, sf_dir, "documents"), tokenizer_file(),
                           public_tokenizers.path("piece_bpe_32k.model"))


@query(r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, 'und') AS lang, coalesce(text, '') AS t FROM documents),
p AS (
  SELECT r, lang, unnest(regexp_split_to_array(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                               'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
n AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY lang),
g AS (
  SELECT lang, m, unnest([array_to_string(ws[i:i + m - 1], ' ') FOR i IN range(1, len(ws) - m + 2)]) AS phrase
  FROM w, (SELECT unnest([1, 2, 3, 4]) AS m) WHERE len(ws) >= m),
f AS (SELECT lang, m, phrase, count(*) AS f, string_split(phrase, ' ') AS ws
      FROM g GROUP BY lang, m, phrase HAVING count(*) >= 30),
c AS (SELECT lang, phrase, m, f AS a, ws, unnest(range(1, m)) AS k FROM f WHERE m > 1),
s AS (
  SELECT c.lang, c.phrase, c.m, c.a, k, x.f AS l, y.f AS r, ((2000000::HUGEINT * c.a) // (x.f + y.f))::BIGINT AS score
  FROM c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.ws[1:k], ' ')
         JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.ws[k + 1:], ' ')),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
i AS (
  SELECT lang, inner_phrase AS phrase, max(f) AS longer
  FROM (SELECT lang, f, unnest(flatten([[array_to_string(ws[j:j + q - 1], ' ') FOR j IN range(1, m - q + 2)]
                                        FOR q IN range(2, m)])) AS inner_phrase FROM f WHERE m > 2)
  GROUP BY ALL),
o AS (
  SELECT b.lang, b.phrase, a, l, r, n.n, score,
         row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank
  FROM b JOIN n ON n.lang = b.lang LEFT JOIN i ON i.lang = b.lang AND i.phrase = b.phrase
  WHERE longer IS NULL OR 100 * longer < 80 * a)
SELECT lang, rank, phrase, a, l, r, n, score FROM o WHERE rank <= 2000
""")
def op13_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The strongest collocations of each language."""
    return phrases.collocations(table(spark, sf_dir, "documents"))
