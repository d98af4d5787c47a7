import html
import re

from phenolens.llm import html_extraction as H
from phenolens.llm import queries

from conftest import SF

PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>var a="</p><article>";</script></head>
<body><header>Site</header><nav><ul><li><a>x</a><li><a>y</a></ul></nav><!-- c --><div class="ad-box">Buy</div>
<div class="notice">Cookies!</div><article><h1>{title}</h1><div class="share">Share me</div>{body}
<p class="fixed">Read our terms</p></article><aside>side</aside><form>f<input></form>
<div id="comments">nice<p>one</p></div><footer>&copy;</footer></body></html>"""


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, host string, rule string")


def test_query_against_the_articles(spark):
    rows = queries.QUERIES["op4_html_extraction"](spark, SF["0.01"]).collect()
    source = {r["page_id"]: r["html"] for r in queries.table(spark, SF["0.01"], "pages").collect()}
    assert len(rows) == len(source)
    for r in rows:
        body = re.search(r"<article>(.*?)(?:</article>|\Z)", source[r["page_id"]], re.S)[1]
        want = html.unescape(re.sub(r"</?(?:p|h1|br|div)\b[^>]*>", " ", body).replace("<b>", "").replace("</b>", ""))
        assert r["text"] == " ".join(want.split()) and r["n_chars"] == len(r["text"])


def test_parts_that_are_not_the_article(spark):
    rows = [(i, f"http://a.example/{i}", PAGE.format(title=f"Title &amp; {i}", body="".join(
        f"<p>Par {i} {k}\n  with <b>bo</b>ld<br>text" for k in range(i % 4))), "h", "r") for i in range(12)]
    got = {r["page_id"]: r["text"] for r in H.extract_main(pages(spark, rows)).collect()}
    for i in range(12):
        assert got[i] == " ".join([f"Title & {i}"] + [f"Par {i} {k} with bold text" for k in range(i % 4)])


def test_odd_pages(spark):
    rows = [(1, None, None, "", ""), (2, "", "", "", ""), (None, "http://b.example/", "<p>only <i>this", "", ""),
            (4, "not a url", "no markup, 1 < 2 &lt; 3", "", ""), (4, "not a url", "no markup, 1 < 2 &lt; 3", "", ""),
            (5, "http://c.example/", "<div><p>long " + "word " * 50000 + "</div>", "", ""),
            (6, "http://c.example/", "<article><p>cut off <a href='x", "", ""),
            (7, "http://d.example/", "<!-- open <p>x", "", ""), (8, "http://d.example/", "<p a=\"b>x</p>y", "", "")]
    got = {(r["page_id"], r["url"]): r["text"] for r in H.extract_main(pages(spark, rows)).collect()}
    assert got[(1, None)] == got[(2, "")] == "" and got[(None, "http://b.example/")] == "only this"
    assert got[(4, "not a url")] == "no markup, 1 < 2 < 3" and len(got[(5, "http://c.example/")]) == 250004
    assert got[(6, "http://c.example/")] == "cut off" and got[(7, "http://d.example/")] == ""
    assert H.extract_main(pages(spark, [])).collect() == []


def test_wrapper_has_optional_and_repeated_groups_and_slots():
    w = H.merge(H.page_wrapper(f"<body><h1>Same</h1><ul>{'<li>a' * n}</ul>{'<div>x</div>' * (n > 1)}<p>{n}</p></body>")
                for n in (1, 2, 3))
    assert H.regular_expression(w) == "(<body>(<h1>=T</>)(<ul>(<li>=T</>)+</>)(<div>=T</>)?(<p>#T</>)</>)"


def test_partial_wrappers_merge_in_any_order():
    made = [f"<body><p>{i}</p>{'<div>d</div>' * (i % 2)}<p>z</p></body>" for i in range(6)]
    alone = H.rules(H.merge(map(H.page_wrapper, made)))
    halves = [H.merge(map(H.page_wrapper, made[:3])), H.merge(map(H.page_wrapper, made[3:]))]
    assert H.rules(H.merge(halves[::-1])) == alone


def extracted(made):
    rule = H.rules(H.merge(map(H.page_wrapper, made)))
    return [H.extract(p, rule) for p in made]


def test_text_beside_the_largest_container_of_an_article_stays():
    made = [f"<body><nav>n</nav><article><h1>Title {i}</h1><p>Lead {i}</p><div class='body'><p>{'word ' * 50}{i}</p></div>"
            f"</article></body>" for i in range(8)]
    assert extracted(made) == [f"Title {i} Lead {i} {'word ' * 50}{i}" for i in range(8)]
    made = [p.replace("article>", "div>") for p in made]
    assert extracted(made) == [f"Title {i} Lead {i} {'word ' * 50}{i}" for i in range(8)]


def test_names_of_layouts_do_not_remove_the_article():
    for name in ("class='content with-sidebar'", "class='layout-sidebar-right'", "class='post no-comments'",
                 "class='page-menu-open'", "id='content-side'"):
        made = [f"<body><div {name}><article><h1>T {i}</h1><p>text {i}</p></article></div><div class='sidebar'>s {i}</div>"
                f"</body>" for i in range(8)]
        assert extracted(made) == [f"T {i} text {i}" for i in range(8)]
        made = [p.replace("article>", "div>") for p in made]
        assert extracted(made) == [f"T {i} text {i}" for i in range(8)]


def test_comments_longer_than_the_article_are_still_left_out():
    made = [f"<body><article><p>text {i}</p></article><div id='comments'>{f'<div><p>said {i} {i}</p></div>' * 9}</div></body>"
            for i in range(8)]
    assert extracted(made) == [f"text {i}" for i in range(8)]
    made = [p.replace("<div><p>", "<p>").replace("</p></div>", "</p>") for p in made]
    assert extracted(made) == [f"text {i}" for i in range(8)]


def test_formulas_and_captions_of_an_article_stay():
    made = [f"<body><article><p>Let <math><mi>x</mi><mo>=</mo><mn>{i}</mn></math> be</p><figure><img><figcaption>Fig {i}"
            f"</figcaption></figure></article></body>" for i in range(8)]
    assert extracted(made) == [f"Let x={i} be Fig {i}" for i in range(8)]


def test_copies_of_a_page_make_no_template():
    other = [f"<body><div><p>text {i}</p></div></body>" for i in range(8)]
    for copies in (1, 4, 5, 9):
        made = other + ["<body><div><p>a page</p><blockquote>quoted once</blockquote></div></body>"] * copies
        assert extracted(made)[8:] == ["a page quoted once"] * copies
    assert extracted(["<body><div><p>a page</p></div></body>"] * 9) == ["a page"] * 9


def test_headings_of_articles_stay():
    made = [f"<body><article><h1>T {i}</h1>{'<h2>Summary</h2><div>In short</div>' * (i % 2)}<p>text {i}</p></article></body>"
            for i in range(16)]
    assert extracted(made) == [f"T {i} {'Summary In short ' * (i % 2)}text {i}" for i in range(16)]


def test_pages_are_counted_alike_in_any_order():
    made = [f"<body><p>{i % 6}</p><div>d</div></body>" for i in range(40)]
    whole = H.rules(H.merge(map(H.page_wrapper, made)))
    parts = [H.merge(map(H.page_wrapper, made[k::5])) for k in range(5)]
    assert H.rules(H.merge(parts)) == H.rules(H.merge(map(H.page_wrapper, made[::-1]))) == whole
    assert whole["template"]
