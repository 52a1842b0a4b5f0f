"""WARC round trips and main texts of pages."""
import hashlib

import pytest

from ride_analytics.llm import site_templates, warc
from ride_analytics.sources.storage import fresh_path

PAGES = "page_id long, url string, html string, digest string, type string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], PAGES)


def test_captures_round_trip(spark):
    long, other = "<p>é WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n</p>" * 10, "x" * 100
    rows = [(7, "http://a.example/p?q=1", long), (3, "http://b.example", long), (9, None, long), (4, "http://c.example/", None), (5, "", ""),
            (6, "http://d.example/x\ny", "short"), (8, "http://d.example/", "short"), (10, "u", other), (11, "u", other), (None, "u", other), (3, "http://b.example", long)]
    got = warc.captures(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert len(r.requests) == 1 and len(r.metadata) == 1
        assert r.response.headers["WARC-Record-ID"] == f"<{r.record_id}>"
    want = set()
    for i, _, html in rows:
        data = (html or "").encode()
        first = min((x for x, _, h in rows if h == html and x is not None), default=None)
        revisit = len(data) >= 100 and i != first
        want.add((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    assert {(r.page_id, r.response.payload_bytes, r.response.payload_digest, r.record_type, r.refers_to) for r in got} == want
    texts = {r.page_id: bytes(r.response.payload).decode() for r in got if r.record_type == "response"}
    assert texts[3] == long and texts[4] == "" and texts[6] == "short"
    urls = {r.page_id: r.url for r in got}
    assert urls[9] is None and urls[5] == "" and urls[7] == "http://a.example/p?q=1"


def test_captures_of_an_empty_table_and_many_files(spark):
    assert warc.captures(frame(spark, [])).count() == 0
    rows = [(i, f"http://h/{i}", "z" * i) for i in range(50)]
    got = warc.captures(frame(spark, rows), records_per_file=4).collect()
    assert sorted((r.page_id, r.response.payload_bytes) for r in got) == [(i, i) for i in range(50)]


def test_records_without_companions(spark):
    path = fresh_path(spark, "warc-test")
    warc.write_archives(frame(spark, [(1, "http://h/", "a"), (2, "http://h/2", "b")]), path)
    records = warc.read_archives(spark, path)
    some = warc.assemble(records.where("type <> 'request' AND NOT (type = 'metadata' AND contains(concurrent_to, '-2-'))"))
    assert all(r.requests == [] for r in some.collect())


def test_broken_archives_are_told():
    with pytest.raises(ValueError):
        list(warc.parse_records(b"WARC/1.1\r\nContent-Length: 3\r\n\r\nabcd\r\n\r\n"))
    with pytest.raises(ValueError):
        list(warc.parse_records(b"junk"))


def text_of(page, templates=frozenset()):
    elements, texts = site_templates.parse(page)
    site_templates.subtree_digests(page, elements)
    return site_templates.main_text(elements, texts, templates)


def test_furniture_goes_and_the_article_stays():
    page = ("<!DOCTYPE html><html><head><title>T &am</title><style>p{}</style><script>var t='</p>';</script></head><body class='nav'>"
            "<header>top</header><nav><ul><li>m</ul></nav><!-- <p>no</p> --><div class=\"ad\">buy</div><div id=cookie-notice>c</div>"
            "<article><header><h1>Big &amp; small&nbsp;x</h1></header><p><b>One<br><p>two\n <i>th</i>ree &#233;<div class=share>s</div>"
            "<ul><li>a<li>b</ul><p>1 &lt; 2<script>x<</script></p><section class='comments'><p>c1</p></section><form>f</form></article>"
            "<aside>side</aside><footer>foot</footer>")
    assert text_of(page) == "Big & small x One two three é a b 1 < 2"


@pytest.mark.parametrize("page,text", [("", ""), ("plain  text", "plain text"), ("<p>a<p>b", "a b"), ("<article><p>cut off <b>here", "cut off here"),
                                       ("<!-- open", ""), ("<script>x", ""), ("</p></div>a", "a"), ("a<b>c</b>d<br>e", "acd e"), ("a<hr>b", "a b"),
                                       ("a<div class=ad>x</div>b<i>c</i>", "a bc"), ("<article><div class='post-header'><h1>T</h1></div>x</article>", "T x"), ("<p>x</p>" * 30_000, " ".join("x" * 30_000))])
def test_odd_pages(page, text):
    assert text_of(page) == text


def test_templates_of_a_host_go_but_not_its_articles(spark):
    box = "<div><span>Read our other stories</span></div>"
    pages = [(i, f"http://h.example/{i}", f"<body>{box}<p>Own words {i}</p><div>only {i}</div></body>") for i in range(20)]
    pages += [(100 + i, f"http://few.example/{i}", f"<body>{box}<p>P{i}</p></body>") for i in range(3)]
    pages += [(200 + i, f"http://art.example/{i}", "<article><p>The same text</p><div>Share me</div></article>" + "<!-- -->" * i) for i in range(10)]
    pages += [(300, None, None), (301, "http://h.example/1", ""), (0, "http://h.example/0", pages[0][2])]
    got = {r.page_id: r.text for r in site_templates.extract_main_text(frame(spark, pages)).collect()}
    assert all(got[i] == f"Own words {i} only {i}" for i in range(20))
    assert all(got[100 + i] == f"Read our other stories P{i}" for i in range(3))
    assert all(got[200 + i] == "The same text" for i in range(10))
    assert got[300] == "" and got[301] == ""
    assert site_templates.extract_main_text(frame(spark, pages)).count() == len(pages)
    assert site_templates.extract_main_text(frame(spark, [])).count() == 0


def test_counts_decide_inside_articles(spark):
    words = lambda k: " ".join(f"w{k}x{j}" for j in range(12))
    note = "<p>Sign up for our letter</p>"
    pages = [(i, f"http://n.example/{i}", f"<article><h1>T{i}</h1><p>{words(i)}</p>{note}</article>") for i in range(12)]
    # near copies of one article: their paragraphs recur, but with the same surroundings
    pages += [(100 + i, f"http://c.example/{i}", f"<article><p>{words(1)}</p><p>{words(2)}</p><p>{words(3)} v{i}</p></article>") for i in range(12)]
    got = {r.page_id: (r.text, r.n_templates) for r in site_templates.extract_main_text(frame(spark, pages)).collect()}
    assert all(got[i] == (f"T{i} {words(i)}", 1) for i in range(12))
    assert all(got[100 + i] == (f"{words(1)} {words(2)} {words(3)} v{i}", 0) for i in range(12))


def test_copied_pages_count_once_and_sections_of_a_large_host_go(spark):
    one = "<article><div>The first part</div><section>The second part</section></article>"
    plain = "<h1>Title</h1><p>All of the text</p>"
    pages = [(i, f"http://a.example/{i}", one) for i in range(5)] + [(10 + i, f"http://a.example/x{i}", f"<p>x{i}</p>") for i in range(4)]
    pages += [(20 + i, f"http://b.example/{i}", plain) for i in range(5)]
    menu = "<div><a>News</a> <a>Sport here</a></div>"
    pages += [(1000 + i, f"http://l.example/{i}", f"{menu if i % 10 == 0 else ''}<p>Text {i}</p>") for i in range(600)]
    got = {r.page_id: r.text for r in site_templates.extract_main_text(frame(spark, pages)).collect()}
    assert all(got[i] == "The first part The second part" for i in range(5)) and all(got[20 + i] == "Title All of the text" for i in range(5))
    assert all(got[1000 + i] == f"Text {i}" for i in range(600))


def test_text_outside_an_article_goes_only_where_the_article_is_the_larger_part(spark):
    assert text_of("<article><p>Teaser</p></article><div><p>The long main text</p></div>") == "Teaser The long main text"
    assert text_of("<article><p>The long main text</p></article><div><p>Teaser</p></div>") == "The long main text"
    assert text_of("<article><p> </p></article><p>All</p>") == "All"
    # boxes without telling names and a bar above a teaser article, on every page of a host; one page alone on its host keeps its box
    box = "<div class='x1'><div>Latest from the desk</div><p>Weather fair</p></div>"
    pages = [(i, f"http://t.example/{i}", f"<body>{box}<article><p>Teaser {i}</p></article><div>{f'Main text {i} ' * 5}</div></body>") for i in range(20)]
    pages.append((99, "http://alone.example/", f"<body>{box}<p>Words</p></body>"))
    got = {r.page_id: r.text for r in site_templates.extract_main_text(frame(spark, pages)).collect()}
    assert all(got[i] == f"Teaser {i} " + " ".join([f"Main text {i}"] * 5) for i in range(20))
    assert got[99] == "Latest from the desk Weather fair Words"
