"""Operators on embeddings and pages, and the registered queries."""

import base64
import hashlib
import random
import shutil

import numpy as np
import pytest
from tests_llm_helpers import components

from strata.llm import html_text, pq_dedup, warc
from strata.llm.words import shingle_sets, word_numbers

ROWS = "vec_id long, embedding array<float>, label int, list int, id string"


def test_embedding_links_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(60, 24))
    rows = []
    for i in range(900):
        v = base[rng.integers(60)] + rng.normal(size=24) * rng.choice([0.0, 0.1, 0.2, 0.3])
        rows.append((i, (v * rng.choice([1.0, 5.0])).astype(np.float32), int(rng.integers(3))))
    out = {r.vec_id: r for r in pq_dedup.link(spark.createDataFrame(
        [(i, v.tolist(), lab, 1, "x") for i, v, lab in rows], ROWS)).collect()}
    x = np.array([v for _, v, _ in rows], dtype=float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([lab for _, _, lab in rows])
    links = (x @ x.T >= 0.93) & (label[:, None] == label[None, :]) & ~np.eye(900, dtype=bool)
    want = links.sum(axis=1)
    found = sum(out[i].n_links for i in range(900))
    assert all(out[i].n_links <= want[i] for i in range(900))
    assert found >= 0.995 * want.sum()  # recall against brute force
    parts = components(zip(*np.nonzero(links)), range(900))
    assert sum(out[i].component_id == parts[i] for i in range(900)) >= 890


def test_embeddings_awkward_rows(spark):
    inf, nan = float("inf"), float("nan")
    a, b = [1.0] * 8, [1.0] * 7 + [1.1]
    rows = [(1, a, 0, 0, ""), (2, a, 0, 0, ""), (2, a, 0, 0, ""), (3, b, 0, 0, ""), (4, a, 1, 0, ""),
            (5, a, None, 0, ""), (6, None, 0, 0, ""), (7, [0.0] * 8, 0, 0, ""), (8, [nan] + a[1:], 0, 0, ""),
            (9, [inf] + a[1:], 0, 0, ""), (10, [None] + a[1:], 0, 0, ""), (11, [], 0, 0, ""),
            (12, [1.0, 1.0], 0, 0, ""), (13, [2.0, 2.0], 0, 0, ""), (None, b, 0, 0, "")]
    out = pq_dedup.link(spark.createDataFrame(rows, ROWS)).collect()
    assert len(out) == len(rows)
    by = {}
    for r in out:
        by.setdefault(r.vec_id, []).append(r)
    assert all(r.n_links == 4 and r.component_id == 1 for i in (1, 2, 3, None) for r in by[i])
    assert by[1][0].kept and not by[3][0].kept
    assert all(by[i][0].n_links == 0 and by[i][0].component_id == i for i in (4, 5, 6, 7, 8, 9, 10, 11))
    assert by[13][0].component_id == 12
    assert pq_dedup.link(spark.createDataFrame([], ROWS)).count() == 0


def test_embeddings_large_group_of_near_copies(spark):
    rng = np.random.default_rng(5)
    one = rng.normal(size=16)
    rows = [(i, (one + rng.normal(size=16) * 0.01).tolist() if i % 3 == 0 else rng.normal(size=16).tolist(), 0, 0, "")
            for i in range(1500)]
    out = {r.vec_id: r for r in pq_dedup.link(spark.createDataFrame(rows, ROWS)).collect()}
    assert all(out[i].component_id == 0 and out[i].n_links >= 499 for i in range(0, 1500, 3))


# --- pages -----------------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style></head><body class="layout sidebar-left">
<div id="header">Site name, welcome.</div><nav><ul><li><a href=1>Home</a><li><a href=2>News</a></ul></nav>
<div class="post-content"><h2>A title</h2><p>First paragraph, with some text. It is long enough to be read.
<p>Second&nbsp;one<br>line &lt;two&gt; &#8212; and <b>more</b>, yes.</p><ul><li>item one<li>item two</ul>
<script>var a = "</p><p>no";</script><div class="comments"><p>Great article, thanks! I like it, really.</p></div>
<form><label>Mail, please.</label><input></form><p>Last.</p></div><aside><p>Other things, other links.</p></aside>
<div class="cookie-notice"><p>We use cookies, and more. Accept?</p></div><!-- ad --><footer>&copy; x</footer>"""


def test_html_text_of_a_page():
    assert html_text.extract(PAGE).split("\n") == [
        "A title", "First paragraph, with some text. It is long enough to be read.",
        "Second one line <two> — and more, yes.", "item one", "item two", "Last."]


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("<nav>menu</nav>", ""), ("plain  text", "plain text"), ("<p>open <b>bold", "open bold"),
    ("<article><p>a<p>b</article><p>c, d, e. f", "a\nb"), ("<p>x</p><!-- <p>y</p>", "x"), ("a < b &amp c", "a < b & c"),
    ("<script>x</script>", ""), ("<p", ""), ("<p>one</p" + ">" * 3, "one\n>>")])
def test_html_text_odd_pages(page, text):
    assert html_text.extract(page) == text


def test_html_text_of_a_page_whose_wrapper_is_marked():
    body = "<p>A paragraph of the article, with some words in it.</p>" * 12
    assert html_text.extract(f"<div class='site nav-open'><div class='menu'>x</div>{body}</div>").count("\n") >= 11
    assert html_text.extract("<div class='cookie-notice'><p>We use cookies, accept?</p></div>") == ""


def test_html_text_keeps_whole_articles():
    body = "".join(f"<p>Paragraph {i}, of many words.</p><p>{i}</p>" for i in range(4000))
    out = html_text.extract(f"<body><div class='ad'>Buy, now.</div><article><h1>T</h1>{body}</article></body>")
    assert len(out.split("\n")) == 8001


WORDS = "A sentence of the text, long enough to be read, with marks. "


def test_html_text_beside_articles_that_are_cards():
    post = "".join(f"<p>{i}. {WORDS * 4}</p>" for i in range(5))
    cards = "<article class='card'><p>Other page</p></article>" * 3
    out = html_text.extract(f"<body><div class='post'>{post}</div><div>{cards}</div></body>").split("\n")
    assert out == [f"{i}. {WORDS * 4}".strip() for i in range(5)]


def test_html_text_drops_comments_that_are_articles():
    page = f"<main><h1>T</h1><p>{WORDS * 3}</p><article class='comment'><p>Well said, I like it.</p></article></main>"
    assert html_text.extract(page) == f"T\n{WORDS * 3}".strip()
    assert html_text.extract(f"<article class='post comments-open'><p>{WORDS}</p></article>") == WORDS.strip()


def test_html_text_keeps_all_containers_of_the_text():
    intro, text = (f"<p>{WORDS * n}</p>" for n in (3, 7))
    out = html_text.extract(f"<div class=post><h1>T</h1><div class=intro>{intro}</div><div class=text>{text}</div></div>")
    assert out.split("\n") == ["T", (WORDS * 3).strip(), (WORDS * 7).strip()]


def test_html_text_keeps_lists_tables_and_linked_paragraphs_of_the_body():
    a, b = (f"<p>{WORDS * n}</p>" for n in (11, 9))
    out = html_text.extract(
        f"<body><h1>T</h1><div class=a>{a}</div><ul><li>x<li>y</ul><table><tr><td>1<td>2</table>"
        f"<p><a href=1>all of it in a link</a></p><div class=b>{b}</div><ol><li>z</ol></body>")
    assert out.split("\n") == ["T", (WORDS * 11).strip(), "x", "y", "1", "2", "all of it in a link", (WORDS * 9).strip(), "z"]


@pytest.mark.parametrize("part", [
    "<p title='The hidden cost'>{}</p>", "<p><a href='/hidden-valley'>{}</a></p>", "<h2 id='discussion'>{}</h2>",
    "<h2 id=social-impact>{}</h2>", "<section id='search-methods'><p>{}</p></section>",
    "<section id='related-work'><p>{}</p></section>", "<div id='legal-notice-of-1901'><p>{}</p></div>"])
def test_html_text_marks_are_attributes_and_not_slugs(part):
    out = html_text.extract(f"<article><p>{WORDS}</p>{part.format('Kept words.')}<p>{WORDS}</p></article>")
    assert out.count("\n") == 2 and "Kept words." in out


@pytest.mark.parametrize("mark", ["hidden", "HIDDEN=''", "class='comments'", "id=comments", "role=search",
                                  "aria-hidden=true", "style='display: none'", "title='x' class=\"share\""])
def test_html_text_marks_of_parts(mark):
    assert html_text.extract(f"<article><p>{WORDS}</p><div {mark}><p>Dropped.</p></div></article>") == WORDS.strip()


def test_html_text_never_fails():
    rng = random.Random(1)
    pieces = ["<p>", "</p>", "<div class='a", "'>", "<b>", "</b>", "text, ", "&am", "<!--", "-->", "<", ">", "<script>",
              "</script>", "<li>", "</ul>", "<article>", "</article>", "<td>", "</table>", "\"", "\x00", "<a href=>"]
    for _ in range(3000):
        html_text.extract("".join(rng.choice(pieces) for _ in range(rng.randint(0, 25))))


def test_html_text_frame(spark):
    pages = spark.createDataFrame([(1, "u", "<p>a b</p>", "x"), (None, None, None, "y"), (1, "u", "<p>a b</p>", "x")],
                                  "page_id long, url string, html string, tag string")
    out = html_text.extract_pages(pages)
    assert out.columns == ["page_id", "url", "tag", "text", "n_chars"]
    assert sorted((r.text, r.n_chars) for r in out.collect()) == [("", 0), ("a b", 3), ("a b", 3)]
    assert html_text.extract_pages(pages.limit(0)).count() == 0


# --- archives --------------------------------------------------------------------------------

def test_warc_reads_only_what_the_manifest_names(spark, tmp):
    pages = spark.createDataFrame([(i, f"u{i}", f"<p>{i}</p>") for i in range(40)], "page_id long, url string, html string")
    names = [r.archive for r in warc.write_archives(pages, tmp).collect()]
    root = f"{tmp.removeprefix('file://')}/archives"
    shutil.copy(f"{root}/{names[0]}", f"{root}/part-00000-999.warc.zst")  # left by a lost attempt
    assert sorted(r.page_id for r in warc.read_archives(spark, tmp).collect()) == list(range(40))


def test_warc_round_trip(spark, tmp):
    rows = [(i, f"http://e.com/{i}", f"<p>page {i % 40} {'word ' * (i % 40)}</p>", "x") for i in range(300)]
    rows += [(400, None, None, "y"), (401, "http://e.com/a b\r\nX: 1", "", "y"), (None, "u", "<p>page 1 word </p>", "y"),
             (7, "again", "<p>page 7 " + "word " * 7 + "</p>", "x"), (402, "long", "zé" * 400_000, "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, archive string")
    manifest = warc.write_archives(pages, tmp, max_bytes=1 << 14)
    out = warc.read_archives(spark, tmp).collect()
    assert manifest.agg({"records": "sum"}).first()[0] == len(rows) + manifest.count()
    first = {}
    for i, _, h, _ in rows:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    want = sorted(((i is None, i or 0), len((h or "").encode()),
                   base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode(),
                   *(("response", -1) if i == first[h or ""] else ("revisit", first[h or ""]))) for i, _, h, _ in rows)
    assert sorted(((r.page_id is None, r.page_id or 0), r.payload_bytes, r.payload_digest, r.record_type,
                   -1 if r.refers_to is None else r.refers_to) for r in out) == want
    assert all(bytes(r.payload).decode() == rows[r.page_id][2] for r in out
               if r.record_type == "response" and r.page_id is not None and r.page_id < 300 and r.page_id != 7)
    empty = f"{tmp}-empty"
    warc.write_archives(pages.limit(0), empty)
    assert warc.read_archives(spark, empty).count() == 0


def archive(n=100):
    records = [warc.page_record(i, "u", b"<p>%d words here</p>" % i * 20, hashlib.sha1(b"<p>%d words here</p>" % i * 20).digest(),
                                i, True, "2024-01-01T00:00:00Z") for i in range(n)]
    writer = warc.ArchiveWriter(records)
    for r in records:
        writer.add(r)
    return b"".join(writer.parts)


def test_archive_has_a_dictionary_frame_and_a_frame_per_record():
    data = archive()
    kinds = [m for m, _, _ in warc.frames(data)]
    assert kinds[0] == warc.DICTIONARY_MAGIC and kinds[1:] == [warc.FRAME_MAGIC] * 100
    assert [r["page_id"] for r in warc.read_archive(data)] == list(range(100))
    small = archive(3)  # too few records for a dictionary
    assert len(list(warc.read_archive(small))) == 3


def test_broken_archives_are_refused():
    data = archive()
    with pytest.raises(ValueError):
        list(warc.read_archive(data[:-3]))
    with pytest.raises(ValueError):
        list(warc.read_archive(b"junk" + data))
    spans = list(warc.frames(data))
    _, a, b = spans[5]
    with pytest.raises(ValueError):
        list(warc.read_archive(data[:a + 10] + bytes([data[a + 10] ^ 255]) + data[a + 11:]))
    good = warc.page_record(1, "u", b"abc", hashlib.sha1(b"abc").digest(), 1, True, "d")
    for bad in (good.replace(b"abc", b"abd"), good.replace(b"WARC/1.1", b"XARC"), good[:-1],
                good.replace(b"WARC-Date", b"No-Date"), good.replace(b"html; charset=utf-8\r\nContent-Length: 3", b"html; charset=utf-8\r\nContent-Length: 4")):
        with pytest.raises(ValueError):
            warc.parse_record(bad)
    assert warc.parse_record(good)["payload"] == b"abc"


# --- words -----------------------------------------------------------------------------------

def test_word_numbers_follow_the_words():
    texts = ["One two\tone", "", "  ", "tWo x one", "É é"]
    numbers, bounds = word_numbers(texts)
    words = [t.encode().lower().split() for t in texts]
    assert np.diff(bounds).tolist() == [len(w) for w in words]
    flat = [w for ws in words for w in ws]
    seen = {}
    for w, n in zip(flat, numbers):
        assert seen.setdefault(w, n) == n
    assert len(set(seen.values())) == len(seen)
    assert [len(s) for s in shingle_sets(["a b a b a", "a", "", "b  a"], 2)] == [2, 1, 0, 1]
