"""Main texts of made pages, of the given pages, and what alignment must hold to."""

import html as codes
import random
import re

import pytest

from ledger.llm import page_wrappers as pw
from ledger.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "page_id bigint, url string, html string, host string, text string, wrapper binary"


def pages(spark, rows: list[tuple]):
    return spark.createDataFrame([(i, u, h, "own", "own", b"own") for i, u, h in rows], SCHEMA)


def texts(spark, rows: list[tuple]) -> dict:
    return {r.page_id: r.text for r in pw.extract_pages(pages(spark, rows)).collect()}


def one(html: str, others: tuple = ()) -> str:
    root = pw.expression(html)
    for other in others:
        root = pw.align(root, pw.expression(other))
    return pw.extract(html, root, pw.main_slots(root))


@pytest.mark.parametrize(("html", "want"), [
    ("", ""), ("plain text only", "plain text only"), ("<p>one<p>two", "one two"), ("<div>a &lt;b&gt; &amp;amp; &eacute;</div>", "a <b> &amp; é"),
    ("<article><p>x<b>y</b>z <i>w</i><br>v</p></article>", "xyz w v"), ("<article>kept<script>var a='</p>'</script><style>p{}</style> too</article>", "kept too"),
    ("<nav>menu</nav><article><h1>T</h1><p>body</p></article><footer>foot</footer>", "T body"),
    ("<article><p>body<div class='advert'>buy</div><p>more</article>", "body more"),
    ("<main><p>text</p><form><p>name</p><input></form><section id=comments><p>first!</p></section></main>", "text"),
    ("<div class='cookie-notice'>we use</div><div id='content'><p>long text of the page</p></div><div class='sidebar'>side</div>", "long text of the page"),
    ("<article>a<!-- note <p>no</p> -->b</article>", "ab"), ("<article>a<!-- never closed <p>no</p>", "a"), ("<article><p>x <script>never closed", "x"),
    ("<div class='page has-sidebar'><article>in</article></div>", "in"), ("<article><ul><li>1<li>2<ul><li>3</ul><li>4</ul></article>", "1 2 3 4"),
    ("<table><tr><td>a<td>b<tr><td>c</table>", "a b c"), ("<article>1 < 2 and <3</article>", "1 < 2 and <3"), ("<p a='>' b=\">\">q", "q"),
    ("<article>  a\t\n b &nbsp; c</article>", "a b c"), ("<title>t</title><body>b</body>", "b"), ("<article><svg><text>no</text></svg>yes</article>", "yes"),
    ("<article " + "x" * 50 + ">" + "<div>" * 5000 + "deep" + "</div>" * 5000 + "</article>", "deep"),
])
def test_single_pages(html, want):
    assert one(html) == want


def test_template_text_goes_and_headings_stay():
    page = "<body><article><h2>News</h2><p class=by>Read this aloud</p><p>{}</p></article></body>"
    rows = [page.format(f"words of page {i} " * 5) for i in range(5)]
    assert one(rows[0], rows[1:]) == "News " + ("words of page 0 " * 5).strip()
    # Equal pages vary nothing, so nothing counts as template.
    assert one(rows[0], [rows[0]] * 5).startswith("News Read this aloud words")


def made(rng: random.Random, i: int) -> tuple[str, str]:
    """A page and its main text."""
    def words(n):
        return " ".join("".join(rng.choice("abcdeéñ") for _ in range(rng.randint(1, 8))) for _ in range(n))
    blocks = [words(rng.randint(3, 6))] + [words(rng.randint(5, 60)) for _ in range(rng.randint(1, 9))]
    body = [f"<h1>{blocks[0]}</h1>"]
    for b in blocks[1:]:
        body.append(rng.choice(["<p>{}</p>", "<p>{}", "<blockquote>{}</blockquote>", "<ul><li>{}</ul>", "<p><b>{}</b><br>"]).format(b.replace(" ", rng.choice([" ", "\n\t", " <i></i>"]), 1)))
    if rng.random() < 0.5:
        body.insert(2, f"<aside>{words(5)}</aside>")
    menu = "".join(f"<li><a href='/{k}'>{words(1)}</a>" for k in range(rng.randint(1, 7)))
    notice = f"<div class='cookie-banner'>{words(9)}</div>" if rng.random() < 0.3 else ""
    reader = f"<div class=comments><p>{words(20)}</p></div>" if rng.random() < 0.4 else ""
    shell = rng.choice(["<main>{}</main>", "<main>{}</main>", "<main><div class='col wide'>{}</div></main>"])
    return (f"<html><head><title>{blocks[0]}</title></head><body>{notice}<header>{words(3)}</header><nav><ul>{menu}</ul></nav>"
            f"{shell.format(''.join(body))}{reader}<footer>&copy; {words(4)}</footer></body></html>"), " ".join(blocks)


def test_many_hosts(spark):
    rng = random.Random(8)
    rows, want = [], {}
    for i in range(300):
        html, text = made(rng, i)
        rows.append((i, f"https://Host{i % 3 if i % 3 else rng.randrange(12)}.example/{i}", html))
        want[i] = text
    rows += [(1000, None, "<p>no url</p>"), (1001, "nothing", "<p>no host</p>"), (1002, "http://h/", None), (1003, "http://h/", ""), (None, "http://h2/", "<p>no id"), (1002, "http://h/", None)]
    got = pw.extract_pages(pages(spark, rows).repartition(70)).collect()
    assert len(got) == len(rows)
    found = {r.page_id: r.text for r in got}
    assert {i: found[i] for i in want} == want
    assert [found[i] for i in (1000, 1001, 1002, 1003, None)] == ["no url", "no host", "", "", "no id"]
    assert all(r.n_chars == len(r.text) for r in got)


def test_empty_table(spark):
    assert pw.extract_pages(pages(spark, [])).collect() == []


def test_join_when_wrappers_are_large(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(i, f"http://h{i % 4}/", made(rng, i)[0]) for i in range(40)]
    small = texts(spark, rows)
    monkeypatch.setattr(pw, "BROADCAST_BYTES", 0)
    assert texts(spark, rows) == small


def accepts(root: pw.Node, path: tuple) -> bool:
    return pw.TEXT in node_at(root, pw._general(path, root)).children


def node_at(root: pw.Node, path: tuple) -> pw.Node:
    for k in path:
        root = root.children[k]
    return root


def test_alignment_accepts_all_pages_in_any_order():
    rng = random.Random(6)
    htmls = [made(rng, i)[0] for i in range(40)]
    kept = None
    for _ in range(3):
        rng.shuffle(htmls)
        parts = [pw.expression(h) for h in htmls]
        while len(parts) > 1:
            parts = [pw.align(a, b) for a, b in zip(parts[::2], parts[1::2], strict=False)] + parts[len(parts) // 2 * 2:]
        root = pw._unpack(pw._pack(parts[0]))
        assert all(accepts(root, path) for h in htmls for path, *_ in pw.texts_of(h))
        assert kept in (None, pw.main_slots(root))
        kept = pw.main_slots(root)


def test_repeats_and_options():
    root = pw.expression("<article><h1>t</h1><p>a</p><p>b</p><ul><li>c</ul><p>d</p><pre>e</pre></article>")
    article = root.children["article"]
    assert list(article.children) == ["h1", "p", "ul", "pre"]
    assert article.groups["p"] == article.groups["ul"] and "h1" not in article.groups and "pre" not in article.groups
    pw.align(root, pw.expression("<article><p>b</p><pre>e</pre><h1>t</h1></article>"))
    assert article.children["ul"].pages < root.pages and set(article.groups) >= {"h1", "p", "ul", "pre"}


def test_many_kinds_of_one_tag():
    htmls = [f"<main><p class=x>{i}</p>" + "".join(f"<div class='{a}{b}'>text {a}{b}</div>" for a in "abcdefgh" for b in "mnopq") + "</main>" for i in range(3)]
    root = pw.expression(htmls[0])
    for h in htmls[1:]:
        pw.align(root, pw.expression(h))
    assert len(root.children["main"].children) == 2
    assert one(htmls[0], htmls[1:]).startswith("0 text am text an")


def test_given_pages(spark):
    rows = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = QUERIES["op13_html_extraction"](spark, SF).collect()
    assert len(got) == len(rows)
    for r in got:
        inside = rows[r.page_id].split("<article>")[1].split("</article>")[0]
        inside = re.sub(r"</?(?:p|h1)>|<br>", " ", inside).replace("<b>", "").replace("</b>", "")
        assert r.text == " ".join(codes.unescape(inside).split())
