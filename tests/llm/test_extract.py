"""Page text: hand-made pages, brute force over all runs, whole pages of the table, odd rows."""

import html
import random
import re
import time

import numpy as np
import pytest

from flexspark.llm import extract, queries_vectors

LONG = "Here stands a paragraph of the article that is long enough to be told from its surroundings."
ALSO = "And a second one follows it, with as much to say as the first had."


@pytest.mark.parametrize("page, want", [
    (None, ""),
    ("", ""),
    ("no markup &amp; nothing else", "no markup & nothing else"),
    (f"<body><nav><a href=/>Home</a></nav><article><h1>T</h1><p>{LONG}<p>{ALSO}</article><footer>c</footer>", f"T\n\n{LONG}\n\n{ALSO}"),
    (f"<article><header><h1>Title</h1></header><p>{LONG}</p><aside>see also</aside><div class='ad'>Buy this now</div><p>End.</p><footer>by me</footer></article>", f"Title\n\n{LONG}\n\nEnd."),
    (f"<header><h1>Site</h1></header><main><p>{LONG}</p><form>Name <input></form></main><p>Other words outside of main.</p>", LONG),
    (f"<article><p>{LONG}</article><section id=comments><article class='comment'><p>{ALSO} {ALSO} {ALSO}</p></article></section>", LONG),
    (f"<div class='ad'>never closed<article><p>{LONG}</p></article>", LONG),
    (f"<div id='page' class='has-sidebar'><div class='main-menu'>a b c</div><p>{LONG}</p><p>{ALSO}</p><div class='widget_search'>q</div></div>", f"{LONG}\n\n{ALSO}"),
    (f"<div role='banner'>x y z</div><div>{LONG}<br>{ALSO}</div><div role=contentinfo>c</div>", f"{LONG} {ALSO}"),
    (f"<p>{LONG}</p><script>if (a < b) document.write('</p><p>no')</script><style>p{{}}</style><noscript>no</noscript><p>{ALSO}</p>", f"{LONG}\n\n{ALSO}"),
    (f"<!-- <p>no</p> --><p title=\"a > b\">{LONG}</p><!-- open <p>{ALSO}", LONG),
    (f"<p>a&nbsp;b &lt;i&gt; &#233;&#x1F600;&copy; 1 < 2 & 3\n\t x</p>", "a b <i> é😀© 1 < 2 & 3 x"),
    (f"<article><ul><li>one <b>two</b><li>three</ul><table><tr><td>a<td>b<tr><th>c</table><dl><dt>d<dd>e</dl></article>", "one two\n\nthree\n\na\n\nb\n\nc\n\nd\n\ne"),
    (f"<article><p>un<b>bro</b>ken <span class='ad'>buy</span> word <p class=x>cut off in a ta<b", "unbroken word\n\ncut off in a ta"),
    (f"<article><p>{LONG}</article><div class=related><article><p>{ALSO}</article></div><article><p>{ALSO}</article>", f"{LONG}\n\n{ALSO}"),
    ("<nav>only <a>links</a></nav><footer>and more</footer>", ""),
    ("<article><p>&amp;amp; once</p></article>", "&amp; once"),
    (f"<ul><li><a href=1>one</a><li><a href=2>two</a></ul><p>{LONG}</p><p><a href=3>more of this</a></p>", LONG),
])
def test_pages(page, want):
    assert extract.main_text(page, {}) == want


def test_best_run_equals_brute_force():
    rng = np.random.default_rng(3)
    for n in list(range(1, 9)) * 20:
        s = rng.integers(-3, 4, n).astype(float)
        sums = {(i, j): s[i : j + 1].sum() for i in range(n) for j in range(i, n)}
        first, last = extract.best(s)
        if max(sums.values()) <= 0:
            assert last < first
        else:
            assert sums[first, last] == max(sums.values())
    assert extract.best(np.zeros(0)) == (0, -1)


def test_weights_lean_to_what_was_seen():
    w = extract.weights({"p text": (900, 10), "div text": (5, 800), "li link": (20, 400), "<div>": (1, 300), "<p>": (300, 1), "td text": (0, 1)})
    assert w["p text"] > 0.9 and w["div text"] < -0.8 and w["li link"] < -0.8 and w["td text"] > 0.8
    assert w["<div>"] < w["<p>"] <= extract.TAG < 0


def test_learned_weights_cut_unmarked_pages(spark):
    """Labelled pages show that plain words in div and li stand beside the article; a page without marks is then cut right."""
    rows = [(i, f"<div>Imprint and contact of this site</div><article><h1>On {i}</h1><p>{LONG}</p></article><ul><li>tag one<li>tag two</ul>") for i in range(60)]
    learned = extract.fit(spark.createDataFrame(rows, "page_id long, html string"))
    page = f"<div>Imprint and contact of this site</div><h1>On x</h1><p>{LONG}</p><ul><li>tag one<li>tag two</ul>"
    assert extract.main_text(page, learned) == f"On x\n\n{LONG}"


def plain(page):
    """The article of the table's pages, by their one template."""
    page = (page or "").partition("<article>")[2].partition("</article>")[0]
    blocks = (" ".join(html.unescape(re.sub(r"<(?:br|b)>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", page))
    return "\n\n".join(b for b in blocks if b)


def test_whole_table(spark):
    folder = "/root/testdata/sf0.01"
    want = {r.page_id: (r.url, plain(r.html)) for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    rows = queries_vectors.op11_page_text(spark, folder).collect()
    assert {r.page_id: (r.url, r.text) for r in rows} == want and len(rows) == len(want)
    assert all(r.n_chars == len(r.text) for r in rows)


def test_odd_rows(spark):
    """Null and empty pages, null keys, repeated rows, clashing names, very long pages, empty tables."""
    schema = "page_id long, url string, html string, text string, n_chars int, k string"
    long = "<article>" + "<p>word " * 50_000
    rows = [(1, None, None, "x", 1, "k"), (2, "u", "", "x", 1, "k"), (None, "u", "<p>a b", None, None, None), (3, "u", long, "x", 1, "k"), (3, "u", long, "x", 1, "k")]
    df = spark.createDataFrame(rows, schema).repartition(2)
    got = extract.extract(df, ["page_id", "url"])
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted((str(r.page_id), r.n_chars) for r in got.collect()) == [("1", 0), ("2", 0), ("3", 50_000 * 6 - 2), ("3", 50_000 * 6 - 2), ("None", 3)]
    assert extract.extract(df.limit(0), ["page_id"]).count() == 0


def test_tag_soup_stays_linear():
    """Random and hostile markup ends, in time that follows its length."""
    rng = random.Random(5)
    bits = ["<p>", "</p>", "<b>", "</b>", "<div class=\"", "'", "\"", ">", "<", "</", "<!--", "-->", "<script>", "</script>", "<a href='", "x y ", "&amp", "&#x", "<li>", "</ul>", "<td>", "<table>", "<article>", "</article>", "="]
    for _ in range(300):
        extract.main_text("".join(rng.choices(bits, k=rng.randrange(80))), {})
    for unit in ("<p a=\"", "<b><p>", "<div>", "</b>", "<a href='x", "<!--", "<script>", "<", "<li>x", "<x y='"):
        t = time.perf_counter()
        extract.main_text(unit * 30_000, {})
        assert time.perf_counter() - t < 10, unit
