import random
import re
from html import unescape

from tierline.llm import html_extract
from tierline.llm.html_extract import blocks, extract, main_text, shared_lines
from tierline.llm.queries import op7_html_extract

SCHEMA = "page_id long, url string, html string"


def test_markup_rules():
    page = (
        '<body class="has-sidebar"><div class="cookie-notice">We use</div><header><h1>Site</h1></header><div class="content with-sidebar">'
        '<p>a&amp;b &lt;x <b>c</b>d<br>e&nbsp;f</p><script>if(a<b){"</p>"}</script><div id="comments"><p>hi</p></div><!-- x --><p>z</div><form><p>q</p></form><footer>f'
    )
    assert main_text(blocks(page), set()) == "a&b <x cd e f z"
    assert main_text(blocks("<nav><ul><li>menu<article><h1>T</h1><p>one<p>two <aside>x</aside><section class='comments'><article>no</article></section>"), set()) == "T one two"
    assert main_text(blocks("<div class=ad>buy</div>plain &eacute;&#x4e2d; text"), set()) == "plain é中 text"
    assert blocks(None) == blocks("") == [] and main_text([], set()) == ""


def _longest(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
    return t[-1][-1]


def test_shared_lines_are_a_longest_common_subsequence():
    random.seed(1)
    for _ in range(500):
        a, b = ([random.randint(0, 4) for _ in range(random.randint(0, 12))] for _ in range(2))
        shared = sorted(shared_lines(a, b))
        assert len(shared) == _longest(a, b)
        rest = iter(b)
        assert all(a[i] in rest for i in shared)


def test_lines_that_stand_very_often(monkeypatch):
    furniture = [x for i in range(70) for x in (100 + i, 0)]
    own, other = [1, *[0] * 70, 2, *furniture, 3], [4, *furniture, 5]
    assert sorted(shared_lines(own, other)) == [*range(72, 72 + 140)]
    random.seed(3)
    for table_bytes in (64 << 20, 20, 0):
        monkeypatch.setattr(html_extract, "TABLE_BYTES", table_bytes)
        for _ in range(12):
            a, b = (random.choices(range(5), [9, 3, 1, 1, 1], k=random.randint(100, 200)) for _ in range(2))
            shared = sorted(shared_lines(a, b))
            assert len(shared) == _longest(a, b)
            rest = iter(b)
            assert all(a[i] in rest for i in shared)


def test_template_lines_go_where_markup_is_silent(spark):
    def page(i):
        return f"<div>Home of things</div><p>Story {i} begins.</p><p>It ends {i}.</p><div>All rights of things</div>"

    rows = [(i, f"http://x.org/a/{i}", page(i)) for i in range(6)]
    rows += [(10, "http://y.org/a", "<p>alone</p>"), (11, None, "<p>alone</p>"), (12, "http://z.org/1", "<p>same</p>"), (13, "http://z.org/2", "<p>same</p>"), (14, "http://w.org", None), (14, "http://w.org", None)]
    out = extract(spark.createDataFrame([(*r, "k", 1) for r in rows], SCHEMA + ", text string, area int")).collect()
    got = {r["page_id"]: r["text"] for r in out}
    assert len(out) == len(rows) and got[14] == ""
    assert all(got[i] == f"Story {i} begins. It ends {i}." for i in range(6))
    assert [got[i] for i in (10, 11, 12, 13)] == ["alone", "alone", "same", "same"]
    assert extract(spark.createDataFrame([], SCHEMA)).count() == 0


def test_long_page_and_small_neighbourhoods(spark, monkeypatch):
    monkeypatch.setattr(html_extract, "NEAR_ROWS", 2)
    long = "<article>" + "".join(f"<p>word {i}</p>" for i in range(60_000)) + "</article>"
    rows = [(i, f"http://x.org/a/{i}", f"<nav>m</nav><article><p>t{i}</p></article>") for i in range(40)] + [(99, "http://x.org/a/99", long), (98, "http://x.org/a/98", long + "<p>x")]
    got = {r["page_id"]: r["text"] for r in extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(got[i] == f"t{i}" for i in range(40)) and got[99] == got[98] == " ".join(f"word {i}" for i in range(60_000))


FURNITURE = "<div>" + "All the things of the house, every day. " * 20 + "</div>"


def test_short_articles_in_a_heavy_template(spark):
    rows = [(i, f"http://x.org/a/{i}", f"{FURNITURE}<p>Short story {i} of the day.</p>{FURNITURE}") for i in range(5)]
    rows += [(10 + i, f"http://y.org/a/{i}", f"{FURNITURE}<p>Short story {i // 3} of the day.</p>") for i in range(6)]
    got = {r["page_id"]: r["text"] for r in extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(got[i] == f"Short story {i} of the day." for i in range(5))
    assert all(got[10 + i] == f"Short story {i // 3} of the day." for i in range(6))


def test_copies_lose_the_furniture_that_a_page_beyond_them_has(spark):
    def page(story, i):
        return f"<div>Things of the house</div><p>{story * 30}</p><p>Read {i} times</p><div>All rights of things</div>"

    rows = [(i, f"http://x.org/a/{i}", page("The one story. ", i if i < 4 else 4)) for i in range(8)]
    rows.append((8, "http://x.org/a/8", page("Something else. ", 8)))
    got = {r["page_id"]: r["text"] for r in extract(spark.createDataFrame(rows + rows[5:6], SCHEMA)).collect()}
    assert [got[i] for i in range(8)] == [("The one story. " * 30).strip() + f" Read {min(i, 4)} times" for i in range(8)]
    assert got[8] == ("Something else. " * 30).strip() + " Read 8 times"


def test_neighbourhoods_change_no_result(spark, monkeypatch):
    random.seed(7)

    def page(host):
        if random.random() < 0.15:
            return f"<div>Top {host}</div><article><p>Named {random.random()}</p></article>"
        top = FURNITURE if host == "h" else f"<div>Top {host}</div>"
        story = random.choice(["The one story. " * 30, "Another tale of old. " * 30, f"Short {random.randint(0, 3)}"])
        return f"{top}<p>{story}</p><p>Read {random.choice([1, 1, 2, 3])} times</p><div>Rights {host}</div>"

    rows = []
    for host in "ghijk":
        for run in range(8):
            html = page(host)
            rows += [(0, f"http://{host}.org/{run}/{i}", html if random.random() < 0.6 else page(host)) for i in range(random.randint(1, 5))]
    rows = [(i, *r[1:]) for i, r in enumerate(rows)] + [(9999, None, "<p>x</p>"), (9998, "http://z.org/a", "<p>alone</p>")]
    df = spark.createDataFrame(rows, SCHEMA)
    want = sorted(map(tuple, extract(df).collect()))
    assert len(want) == len(rows)
    for near_rows in (1, 3):
        monkeypatch.setattr(html_extract, "NEAR_ROWS", near_rows)
        assert sorted(map(tuple, extract(df).collect())) == want


def test_bounds_hide_no_template(spark, monkeypatch):
    monkeypatch.setattr(html_extract, "NEAR_ROWS", 1)
    first = (1 << 53) + 1
    rows = [(first + i, f"http://x.org/a/{i}", f"<div>Home of things</div><p>Story {i} begins.</p>") for i in range(6)] + [(None, None, None)]
    got = {r["page_id"]: r["text"] for r in extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {first + i: f"Story {i} begins." for i in range(6)} | {None: ""}


def test_query_gives_the_article(spark):
    sf_dir = "/root/testdata/sf0.01"
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    out = op7_html_extract(spark, sf_dir).collect()
    assert len(out) == len(pages)
    for r in out:
        inside = re.search(r"<article>(.*?)(</article>|$)", pages[r["page_id"]], re.S).group(1)
        want = " ".join(unescape(re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", inside))).split())
        assert r["text"] == want and r["n_chars"] == len(want)
