"""Main text against the generator's own markup, and by difference where a
page marks no article."""

import html as entities
import random
import re

from gridcat.llm import page_diff as D
from gridcat.llm import queries

from .conftest import SF_SMALL, prose


def plain_lcs(a, b):
    d = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a)):
        for j in range(len(b)):
            d[i + 1][j + 1] = d[i][j] + 1 if a[i] == b[j] else max(d[i][j + 1], d[i + 1][j])
    return d[-1][-1]


def test_alignment_is_a_longest_common_subsequence(monkeypatch):
    draw = random.Random(2)
    cases = [([draw.randint(0, 6) for _ in range(draw.randint(0, 14))], [draw.randint(0, 6) for _ in range(draw.randint(0, 14))])
             for _ in range(2000)]
    for a, b in cases:
        hit, rest = D.aligned(a, b), iter(b)
        assert len(hit) == plain_lcs(a, b) and all(any(y == a[i] for y in rest) for i in sorted(hit))
    a, b = ([draw.randint(0, 300) for _ in range(600)] for _ in "ab")
    whole = len(D.aligned(a, b))
    source = D.aligned.__code__
    small = source.replace(co_consts=tuple(64 if c == 1 << 26 else c for c in source.co_consts))
    monkeypatch.setattr(D.aligned, "__code__", small)         # halved down to small tables
    assert len(D.aligned(a, b)) == whole == plain_lcs(a, b)


def test_lines_of_markup():
    page = """<html><head><title>t</title><style>p{}</style></head><body class="has-sidebar">
      <script>var t="</p><p>no</p>";</script><nav>menu</nav><div class="site-header">top</div>
      <div id="cookie-notice">cookies</div><!-- <p>no</p> --><main><h1>Head &amp; more&nbsp;x</h1>
      <p>one<br>two <b>three</b> &lt;p&gt; &copy &notit; &#65;&#x42;<p>open <div hidden>secret</div>
      <ul><li>a<li>b</ul><table><tr><td>c</td><td>d</td></tr></table><textarea>no</textarea>
      <form><p>no</p></form><section class="comments"><p>reader</p></section></main>
      <aside>side</aside><p title="a > b">after</p><footer>foot</footer> 1 < 2 <p"""
    kinds = {k: [t for t, kind in D.lines(page) if kind == k] for k in (0, 1, 2)}
    assert kinds[2] == ["Head & more x", "one two three <p> © ¬it; AB", "open", "a", "b", "c d"]
    assert kinds[1] == ["after", "1 < 2"]
    assert kinds[0] == ["menu", "top", "cookies", "secret", "no", "reader", "side", "foot"]
    assert D.lines(None) == D.lines("") == D.lines("<p></p> <br>") == []
    assert D.lines("<p>cut in a tag <a href='x") == [("cut in a tag", 1)]
    assert D.lines("<" * 3000 + "a" * 3000)      # linear, whatever is thrown at it


def site(path, body):
    return f"<body><div>Our site</div><div>Home</div>{''.join(f'<p>{x}</p>' for x in body)}<div>Imprint of us</div></body>"


def test_shared_lines_go_where_no_article_is_marked(spark):
    rows = [(i, f"http://a.example/{i % 3}/{i}", site(i, [prose(i, 12), prose(100 + i, 9)])) for i in range(12)]
    rows += [(100, "http://a.example/0/0", rows[0][2]), (101, "http://a.example/0/0b", rows[0][2]),       # copies of page 0
             (102, "http://b.example/x", site(0, ["alone on its host"])), (103, None, None), (104, "http://c/", ""),
             (105, "http://z.example/1/1", "<article><p>Home</p><p>quoted</p></article>"), (105, "http://z.example/1/1", "<article><p>Home</p><p>quoted</p></article>"),
             (None, "http://d/", "<p>null key</p>")]
    pages = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, digest string, kind int")
    got = D.extract(pages)
    assert got.count() == len(rows) and got.columns == ["page_id", "url", "text", "n_chars", "n_shared", "n_differenced"]
    by = {r.page_id: r for r in got.collect()}
    for i in [*range(12), 100, 101]:
        body = [prose(i % 100 if i < 100 else 0, 12), prose(100 + (i if i < 100 else 0), 9)]
        assert by[i].text == "\n\n".join(body), i
        assert by[i].n_shared == by[i].n_differenced == 3 and by[i].n_chars == len(by[i].text)
    assert by[102].text == "Our site\n\nHome\n\nalone on its host\n\nImprint of us"      # no neighbour, nothing to compare
    assert (by[103].text, by[104].text, by[103].n_chars) == ("", "", 0)
    assert by[105].text == "Home\n\nquoted" and by[None].text == "null key"
    assert D.extract(pages.limit(0)).count() == 0


def test_furniture_inside_an_article_goes_and_quotes_stay(spark):
    quote = prose(500, 12)        # on three of nine pages that lie side by side
    rows = [(i, f"http://a/x{i}", f"<article><p>Filed under news of today</p><p>{prose(i, 12)}</p>"
                                  f"{f'<p>{quote}</p>' if 3 <= i < 6 else ''}<p>Tell your friends</p></article>") for i in range(9)]
    copied = [prose(600 + i, 12) for i in range(30)]      # near copies alone on a host, each with a line of its own
    rows += [(20 + i, f"http://b/x{i}", f"<article>{''.join(f'<p>{x}</p>' for x in [*copied, f'copy {i}'])}</article>")
             for i in range(4)]
    # a passage on three of four pages of a small host, and on a page each of others
    rows += [(30 + i, f"http://c/x{i}", f"<article><p>{quote if i else 'none'}</p><p>{prose(30 + i, 12)}</p></article>")
             for i in range(4)]
    rows += [(40 + i, f"http://d{i // 4}/x{i}", f"<article><p>{prose(40 + i, 12)}</p><p>{'' if i % 4 else quote}</p></article>")
             for i in range(12)]
    got = {r.page_id: r.text for r in D.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[30 + i] == f"{quote}\n\n{prose(30 + i, 12)}" for i in range(1, 4))
    for i in range(9):
        assert got[i] == "\n\n".join([prose(i, 12)] + [quote] * (3 <= i < 6)), i
    for i in range(4):
        assert got[20 + i] == "\n\n".join([*copied, f"copy {i}"])


def test_short_text_in_a_long_template(spark):
    template = [prose(700 + i, 15) for i in range(10)]
    body = [*(prose(i, 12) for i in range(6))]
    rows = [(i, f"http://a/x{i}", "".join(f"<div>{x}</div>" for x in [*template[:5], body[i], *template[5:]])) for i in range(6)]
    assert all(sum(map(len, template)) >= D.COPY_SHARE * (sum(map(len, template)) + len(x)) for x in body)
    copied = [prose(800 + i, 10) for i in range(30)]      # two near copies among other pages of a host
    rows += [(10, "http://b/x1", site(1, copied)), (11, "http://b/x2", site(2, [*copied, "one more line"]))]
    rows += [(12 + i, f"http://b/y{i}", site(i, [prose(900 + i, 12)])) for i in range(4)]
    got = {r.page_id: r.text for r in D.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert [got[i] for i in range(6)] == body
    assert got[10] == "\n\n".join(copied) and got[11] == "\n\n".join([*copied, "one more line"])


def test_near_copy_deletes_nothing(spark):
    body = [prose(i, 10) for i in range(30)]
    rows = [(1, "http://a/x1", site(1, body)), (2, "http://a/x2", site(1, body + ["one more line"]))]
    got = {r.page_id: r.text for r in D.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(line in got[1] and line in got[2] for line in body)


def test_op3_query(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()
    got = {r.page_id: r for r in queries.op3_page_diff(spark, SF_SMALL).collect()}
    assert len(got) == len(pages)
    for p in pages:
        article = re.search(r"<article>(.*?)(?:</article>|$)", p.html, re.S)[1]
        blocks = [" ".join(entities.unescape(re.sub(r"<[^>]*>", "", b.replace("<br>", " "))).split())
                  for b in re.split(r"</?(?:p|h1)>", article)]
        text = "\n\n".join(b for b in blocks if b)
        assert (got[p.page_id].url, got[p.page_id].text, got[p.page_id].n_chars) == (p.url, text, len(text))
