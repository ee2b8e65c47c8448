import importlib.util
import itertools
import json
import random
import sys

import public_tokenizers
import pytest

import __spark_entry__
import corpus_pipeline
from shelfcast.llm import queries, wrappers

PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>if(a<b){{x="</p>"}}</script></head><body>
<nav><ul><li><a href="/a">{a}</a></li><li><a href="/b">b</a></li></ul></nav><div class="ad">{ad}</div>
<article><h1>{title}</h1>{body}</article><footer>&copy; x &middot; {ad}</footer></body></html>"""


def page(k, paragraphs):
    return PAGE.format(a=f"a{k}", ad=f"buy {k}", title=f"Title {k} &amp; more", body="".join(f"<p>Text <b>{k}</b>\n {n}.</p>" for n in range(paragraphs)))


def test_articles_of_a_host(spark):
    rows = [(k, "https://Www.Example.com:80/x", page(k, k % 4)) for k in range(12)] + [
        (100, "https://other.example/", page(100, 2)), (101, "not a url", page(101, 1)), (102, None, "<p>alone</p>"),
        (103, "https://www.example.com/", None), (104, "https://www.example.com/", ""), (105, "https://www.example.com/", "plain & simple"),
        (106, "https://www.example.com/", page(106, 3)[:-30]), (106, "https://www.example.com/", page(106, 3)[:-30])]
    pages = spark.createDataFrame([(*r, "mine") for r in rows], "page_id bigint, url string, html string, Text string").repartition(3)
    got = wrappers.main_text(pages).collect()
    assert len(got) == len(rows) and got[0].asDict().keys() == {"page_id", "url", "html", "text", "n_chars"}
    texts = {r["page_id"]: r["text"] for r in got}
    for k in range(12):
        assert texts[k] == "\n\n".join([f"Title {k} & more", *(f"Text {k} {n}." for n in range(k % 4))])
    assert texts[101] == "Title 101 & more\n\nText 101 0." and texts[102] == "alone"
    assert texts[103] == texts[104] == "" and texts[105] == "plain & simple" and texts[106].endswith("Text 106 2.")
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert wrappers.main_text(pages.where("false")).count() == 0
    found = {r["host"]: r for r in wrappers.infer(pages).collect()}
    assert found["www.example.com"]["pages"] == 17 and "(<p>#text</p>)*" in found["www.example.com"]["expression"]


def test_article_without_a_named_tag():
    odd = """<body><header class="site-header"><h1>Site</h1></header><div id="cookie-notice">We use cookies</div><ul class=menu><li><a href=a>Home</a></ul>
<div class="wrap"><div class="text"><h2>Title</h2><p>First <b>bold</b> paragraph.<br>line</p><div class="ad-slot">Buy</div><p>Second&nbsp;one<p>Third <span class="advert">no</span> yes
<ul><li>one</li><li>two</li></ul><section class="comments"><p>nice</p></section></div><aside>side</aside><form><p>sign up</p></form></div><footer>c</footer>"""
    assert wrappers.extract(odd, None) == "Title\n\nFirst bold paragraph. line\n\nSecond one\n\nThird yes\n\none\n\ntwo"


def test_alignment_makes_groups_optional_and_repeated():
    trees = [wrappers.folded(wrappers.parse(x)[0]) for x in ("<div><p>a</p><p>b</p></div>", "<div><h2>x</h2><p>a</p></div>")]
    assert wrappers.expression(wrappers.aligned(*trees)) == "<div>(<h2>'text'</h2>)?(<p>#text</p>)+</div>"
    long = ["p", "h"] * 600
    other = ["x", *long[5:], "y"]
    pairs = wrappers.common(long, other)
    assert len(pairs) > 1000 and all(long[i] == other[j] for i, j in pairs) and all(a < c and b < d for (a, b), (c, d) in zip(pairs, pairs[1:]))


def test_unmatched_tags_of_an_article_stay():
    bodies = ["<div>a</div><p>b</p><h2>c</h2><div>d</div>", "<div>e</div><h2>f</h2><div><table><tr><td>lost</td></tr></table></div>",
              "<div>g</div><h2>h</h2><div><p>i</p></div><p>j</p><h2>k</h2><div>l</div>"]
    made = [f"<body><nav>n</nav><article>{b}<aside>no</aside></article></body>" for b in bodies]
    trees = [wrappers.folded(wrappers.parse(m)[0]) for m in made]
    wrapper = wrappers.aligned(wrappers.aligned(trees[0], trees[1]), trees[2])
    wrappers.mark(wrapper, 3)
    assert [wrappers.extract(m, wrapper).split() for m in made] == [list("abcd"), ["e", "f", "lost"], list("ghijkl")]
    unseen = made[0].replace("<aside>", "<section><p>new</p><nav>no</nav></section><aside>")
    assert wrappers.extract(unseen, wrapper).split() == [*"abcd", "new"]


def test_long_alignment_is_longest():
    x, y = ["s", *["a", "b"] * 300], ["t", *["c"] * 900, *["a", "b"] * 300, "u"]
    assert len(wrappers.common(x, y)) == 600
    rng = random.Random(2)
    x, y = ([rng.choice("abcdef") for _ in range(n)] for n in (420, 390))
    row = [0] * (len(y) + 1)
    for key in x:
        row = list(itertools.accumulate(range(1, len(y) + 1), lambda left, j: row[j - 1] + 1 if key == y[j - 1] else max(row[j], left), initial=0))
    pairs = wrappers.common(x, y)
    assert len(pairs) == row[-1] and all(x[i] == y[j] for i, j in pairs) and all(a < c and b < d for (a, b), (c, d) in zip(pairs, pairs[1:]))


def test_template_needs_distinct_pages_and_a_share(spark):
    rows = [(k, "https://h.example/", "<body><div><p>only text of a page</p></div></body>") for k in range(4)]
    found = wrappers.infer(spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(2)).collect()
    assert [(r["pages"], json.loads(r["wrapper"])[0]) for r in found] == [(4, 1)]
    few = [f"<body><div><p>text {k}</p>{'<h2>Summary</h2>' if k < 3 else ''}</div></body>" for k in range(40)]
    tree = None
    for page_ in few:
        made = wrappers.folded(wrappers.parse(page_)[0])
        tree = made if tree is None else wrappers.aligned(tree, made)
    wrappers.mark(tree, 40)
    assert wrappers.extract(few[0], tree) == "text 0\n\nSummary"


def test_queries_are_registered():
    names = set(__spark_entry__.queries())
    assert {int(n[2:].split("_")[0]) for n in names if n.startswith("op") and n[2].isdigit()} == set(range(1, 14)) and "pipeline" in names
    assert set(queries.ORACLES) <= names


def test_entry_without_the_subpackage(monkeypatch):
    for name in [m for m in sys.modules if m.startswith("shelfcast.llm") or m == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "shelfcast.llm", None)
    spec = importlib.util.spec_from_file_location("entry_alone", __spark_entry__.__file__)
    alone = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(alone)
    assert "pipeline" not in alone.queries() and "pipeline" not in alone.oracle_sql() and "feature_means" in alone.queries()


def test_pipeline_on_a_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    held, seen = docs, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        held = stage(spark, held, sf_dir).cache()
        assert held.columns == docs.columns and 0 < held.count() <= seen, name
        seen = held.count()
    kept = {r["doc_id"] for r in held.collect()}
    bad = [d for d, y in labels.items() if y == 0]
    assert sum(d in kept for d in bad) <= 0.2 * len(bad)
    assert corpus_pipeline.STAGES[-1][1](spark, held, sf_dir).select("doc_id").distinct().count() == seen


def test_stages_on_edges(spark, sf_dir, edge_docs, no_docs):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, edge_docs, sf_dir)
        assert got.columns == edge_docs.columns and got.count() <= 9, name
        assert stage(spark, no_docs, sf_dir).count() == 0, name
    one_each = corpus_pipeline.jaccard_join(spark, edge_docs, sf_dir)
    assert one_each.count() == 8 and one_each.where("doc_id is null").count() == 1


@pytest.mark.parametrize("name", ["op4_neighbours", "op7_html"])
def test_queries_run(spark, sf_dir, name):
    assert queries.QUERIES[name](spark, sf_dir).count() > 0 and public_tokenizers


def test_deep_pages_do_not_end_the_job(spark):
    """Unclosed and deeply nested tags, alone and next to an ordinary page of the host."""
    depth = 20_000
    rows = [(1, "http://h/1", "<div>" * depth), (2, "http://h/2", "<div>" * depth + "<p>Deep text.</p>" + "</div>" * depth),
            (3, "http://h/3", page(3, 2)), (4, "http://h/4", "<article>" + "<div>" * depth + "<p>Inside.</p></article>"),
            (5, "http://h/5", "<ul><li>" * depth + "x"), (6, "http://h/6", "</div>" * depth + "<p>End</p>" + "<a.b>" * 50 + "</a.b>" * 60)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = {r["page_id"]: r["text"] for r in wrappers.main_text(pages.coalesce(1)).collect()}
    assert len(got) == 6 and got[1] == "" and got[4] == "Inside." and got[3].startswith("Title 3 & more")
    assert got[2] == "Deep text."


def test_flat_dump_is_read_back():
    tree = wrappers.folded(wrappers.parse("<div><p>a</p><p>b</p><ul><li>x<li>y</ul></div><div><b>c</b></div>")[0])
    again = wrappers.Node.read(json.loads(json.dumps(tree.dump())))
    assert again.dump() == tree.dump() and wrappers.expression(again) == wrappers.expression(tree)


def test_a_slash_closes_no_script():
    text = wrappers.extract("<article><p>One.</p><script src=/a/>var x=1;</script><style/>p{}</style><p>Two <svg/>three.</p></article>", None)
    assert "var" not in text and "{" not in text and text.replace("\n", " ").split() == ["One.", "Two", "three."]
