import re
import time

import numpy as np

from ledgermill.llm import main_text as m
from ledgermill.llm.queries import op9_main_text

FOLDER = "/root/testdata/sf0.01"


def test_labelled_pages_left_out_in_turn():
    pages = [p for p in m.LABELLED.read_text().splitlines() if p and p[0] != "#"]
    rows, labels = [], []
    for page in pages:
        found = m.blocks(re.sub(r"\[(\d+)(\*?)\]", lambda x: " ".join(["main" if x[2] else "rest"] * int(x[1])), page))
        rows.append(m.features(found))
        labels.append(np.array(["main" in b.text for b in found]))
    right = total = 0
    for k in range(len(pages)):
        tree = m.grow(np.concatenate(rows[:k] + rows[k + 1 :]), np.concatenate(labels[:k] + labels[k + 1 :]))
        right += (tree(rows[k]) == labels[k]).sum()
        total += len(labels[k])
    assert right >= 0.93 * total


def test_query_gives_the_articles(spark):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    rows = op9_main_text(spark, FOLDER).collect()
    assert len(rows) == len(pages)
    for r in rows:
        inner = re.search(r"<article>(.*)</article>", pages[r["page_id"]], re.S)[1]
        want = [" ".join(m.unescape(re.sub(r"<(?!/?(p|h1)\b)[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)[^>]*>", inner)]
        assert r["text"] == "\n".join(x for x in want if x)
        assert r["n_chars"] == len(r["text"])


def test_other_layouts():
    tree = m.train()
    long = "word " * 40
    page = f"""<!doctype html><head><title>T &amp; <b></title><style>p>a{{}}</style></head><body class="has-sidebar">
    <div class="cookie-banner"><p>We use cookies for {long}</p></div><header class="site-header"><a href=/>Home</a><p>Slogan {long}</p></header>
    <main><article><header><h1>A &lt;title&gt; &#233;</h1></header><p>{long}<br>  first\n</p><script>if (a<b) "</p>"</SCRIPT>
    <div class='advert box'>Buy {long}</div><p>x < y &nbsp;and  z<p>Unclosed <b>bold</p><aside>Related {long}</aside>
    <form><p>Sign up {long}</p><select><option>One</select></form><!-- <p>no</p> --><p>Short.</p></article>
    <section id="comments"><article class="comment"><div class="content"><p>Nice {long}</p></div></article></section></main>
    <footer><p>&copy; {long}</p></footer></body>"""
    words = long.strip()
    assert m.main_text(tree, page).split("\n") == ["A <title> é", words + " first", "x < y and z", "Unclosed bold", "Short."]
    page = f"<body><div class=sidebar><div class='content'><p>{long}</p></div></div><div class='post'><p>{long}</p><p>End.</p></div>"
    assert m.main_text(tree, page) == words + "\nEnd."


def test_edges(spark):
    tree = m.train()
    pages = [None, "", "plain", "<", "<p", "<!--", "<script>x", "<p>a</p" , "&am", "<div>" * 3000 + "deep" + "</div>" * 3000,
             "<article><p>" + "lang " * 100_000 + "</p></article>", "<a title=\"x>" * 2000, "<article><p>b</p></article>", "<article><p>b</p></article>"]
    frame = spark.createDataFrame([(i, h, "t", 1) for i, h in enumerate(pages)], "page_id long, html string, text string, key int")
    got = {r["page_id"]: r["text"] for r in m.extract(frame, tree).collect()}
    assert len(got) == len(pages)
    assert got[0] == got[1] == got[4] == got[5] == got[6] == ""
    assert len(got[10]) == 499_999 and got[12] == got[13] == "b"
    assert m.extract(frame.limit(0), tree).collect() == []


def test_names_speak_by_their_head_word():
    say = lambda name: m.names(f' class="{name}"')
    assert say("text-ad-free").isdisjoint(m.FURNITURE | m.CONTENT) and say("meta-analysis").isdisjoint(m.FURNITURE)
    assert say("site-header") == {"header"} and say("comment-list") == {"comment"} and say("ad_slot main-nav") == {"ad", "nav"}
    assert say("has-sidebar") == say("with-sidebar") == set() and say("list") == {"list"}


def test_pages_of_layouts_without_article():
    """Of every layout the main blocks; none of these pages is among the labelled ones."""
    tree, long = m.train(), "word " * 40
    for page in (
        f"<body><article><p>*{long}</p><div class='text-ad-free'><p>*{long}</p></div><section class='meta-analysis'><p>*x {long}</p></section></article>",
        f"<body><div class=content><p>*{long}</p><ul><li><a>*one</a></li><li><a>*link two here</a></li></ul><p>*{long}</p><p>*last words</p></div>",
        f"<body><h1>*Title here</h1><p>*{long}</p><p>*{long}</p><p>Copyright 2024 Example</p></body>",
        f"<body><div><a>x</a> <a>y</a></div><h1>*T</h1><div>*{long}</div><div>*{long}</div><div>Copyright 2024 Example Inc</div></body>",
        f"<body><div id=main-nav><a>x</a></div><div class=post-content><p>*{long}</p><p>*End</p><div class=ad-slot>{long}</div></div><div class=comment-list><p>{long}</p></div>",
        f"<body><p><a>a</a> <a>b</a></p><h2>*Head</h2><p>*{long * 2}</p><p>*{long}</p><p>*{long}</p><p><a>next page</a></p>",
        f"<body><div role=navigation><a>a</a></div><main><h1>*H</h1><p>*{long}</p><aside>{long}</aside></main><div class=site-footer><p>{long}</p></div>",
    ):
        want = [b.text for b in m.blocks(page) if b.text.startswith("*")]
        assert m.main_text(tree, page).split("\n") == want


def test_word_counts_and_link_density_decide_where_names_say_nothing():
    """A page without telling names: the same blocks are main text or not by their words and links."""
    tree, long = m.train(), "word " * 45
    page = f"<body><div><a>a b</a> <a>c</a></div><div>{long}</div><div>{long}</div><div>{{}}</div></body>"
    kept = [m.main_text(tree, page.format(last)).count("\n") for last in (long, "three short words", f"<a>{long}</a>")]
    assert kept == [2, 1, 1]
    assert ((tree.feature >= 0) & (tree.feature < 6)).any()  # nodes on words and links of a block and its neighbours


def test_reading_is_linear_in_nesting():
    start = time.perf_counter()
    assert m.main_text(m.train(), "<div>x" * 100_000) is not None
    assert time.perf_counter() - start < 10
