"""Main text of pages, and the corpus pipeline from end to end."""

import html
import random
import re

import pytest

import corpus_pipeline
from llm_support import FOLDER, HAS_TABLES, TOKENIZER, docs, sentence
from test_llm_dedup import brute_components, brute_line_dedup, brute_measures
from vecspark.llm.html_text import extract_text, main_text, smoothed

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var x = "</p><p>no";</script></head>
<body class="has-sidebar"><header>Site</header><nav><ul><li><a href="/">Home</a></li></ul></nav>
<div class="cookie-notice">We use cookies.</div>{body}<aside>Side</aside><form><label>Mail</label><input></form>
<section id="comments"><p>Nice one!</p></section><footer>&copy; me</footer></body></html>"""


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


@pytest.mark.parametrize(
    "body, text",
    [
        ("<article><h1>Head &amp; tail</h1><p>One  <b>two</b>three<br>four<p>No.</article>", "Head & tail One twothree four No."),
        ("<article><div class='ad'>Buy</div><p>Short.</p><p>" + "long " * 60 + "</p><p>x</p></article>", "Short. " + "long " * 59 + "long x"),
        ("<main><p>alpha</p><ul><li>beta<li>gamma</ul></main>", "alpha beta gamma"),
        ("<div id='c'><h2>Title</h2><p>" + "word " * 40 + "</p><p>end</p></div>", "Title " + "word " * 39 + "word end"),
        ("<article><p>a<!-- no --> b</p><script>1</script><p>c&nbsp;&#233;&lt;</p><article class='comment'>no</article></article>", "a b c é<"),
        ("<article><p><b>unclosed<br><p>next</i></article>", "unclosed next"),
    ],
)
def test_main_text(body, text):
    assert main_text(PAGE.format(body=body)) == text


@pytest.mark.parametrize(
    "body, text",
    [
        # Headline and lead outside the part that holds most.
        ("<div id='c'><h1>Head</h1><div><p>{0}</p></div><div><p>{1}</p><p>{1}</p><p>{1}</p></div></div>", "Head {0} {1} {1} {1}"),
        # One section that is much longer than the others, and a headline in a part of its own.
        (
            "<div><div><h1>Head</h1></div><section><p>{0}</p></section><section><p>{2}</p></section>"
            "<section><p>{0}</p><p>end</p></section></div>",
            "Head {0} {2} {0} end",
        ),
        # Text in main beside a card, and beside an article that is a card only.
        ("<main><p>{1}</p><p>{1}</p><article>Card</article></main>", "{1} {1} Card"),
        ("<div><p>{1}</p><p>{1}</p><p>{1}</p></div><article>A card of some words</article>", "{1} {1} {1} A card of some words"),
        # A page in a form; a search form in it would be nested, which HTML doesn't know.
        ("<form id='f'><div><h1>Head</h1><p>{1}</p><p>{0}</p></div></form>", "Head {1} {0}"),
        ("<form><article><p>{1}</p></article></form>", "{1}"),
        # What is outside an article that holds most stays outside.
        ("<div>Crumb</div><article><p>{1}</p><p>{1}</p></article><div>Tag</div>", "{1} {1}"),
    ],
)
def test_content_is_whole_without_one_article(body, text):
    parts = [" ".join(["lead"] * 30), " ".join(["word"] * 80), " ".join(["long"] * 600)]
    assert main_text(PAGE.format(body=body.format(*parts))) == text.format(*parts)


@pytest.mark.parametrize(
    "part, kept",
    [
        ("<header><h1>Head</h1><p>A lead.</p></header>", "Head A lead."),
        ("<div class='post-header'><h1>Head</h1><div>By me</div></div>", "Head By me"),
        ("<section class='related-work'><h2>Work</h2><p>{1}</p></section>", "Work {1}"),
        ("<p id='notice-of-1848'>{0}</p>", "{0}"),
        # Without headline or prose, or by a plain name, they are what they are called.
        ("<header><a href='/'>Home</a> <a href='/x'>More</a></header>", ""),
        ("<div class='related-posts'><ul><li><a href='/a'>One more</a></li></ul></div>", ""),
        ("<div class='notice'><p>{1}</p></div>", ""),
        ("<div class='cookie-notice'><p>{1}</p></div>", ""),
        ("<div class='related-ads'><p>{1}</p></div>", ""),
        ("<header role='banner'><p>{1}</p></header>", ""),
        ("<header hidden><h1>Head</h1></header>", ""),
    ],
)
def test_names_alone_do_not_remove_parts_of_an_article(part, kept):
    words = [" ".join(["lead"] * 40), " ".join(["word"] * 80)]
    body = f"<article>{part.format(*words)}<p>{words[1]}</p><p>end</p></article>"
    assert main_text(PAGE.format(body=body)) == f"{kept.format(*words)} {words[1]} end".strip()


def test_page_edges(spark):
    assert main_text("") == "" and main_text("no tags\n at all") == "no tags at all"
    assert main_text("<div>" * 3_000 + "deep") == "deep" and main_text("<p>a" * 3_000) == " ".join(["a"] * 3_000)
    assert main_text("<article><p>half <b") == "half" and main_text("<script>never closed <p>x") == ""
    rows = [(1, "u", None), (1, "u", ""), (None, None, "<p>x</p>"), (2, "v", PAGE.format(body="<article>y</article>"))] * 2
    frame = pages(spark, rows).selectExpr("*", "page_id AS n_chars")
    found = extract_text(frame)
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted(r.text for r in found.collect()) == ["", "", "", "", "x", "x", "y", "y"]
    assert not extract_text(frame.limit(0)).collect()


def test_smoothing_keeps_constants():
    assert smoothed(smoothed(__import__("numpy").full(5, 3.0))).tolist() == pytest.approx([3.0] * 5)


@pytest.mark.skipif(not HAS_TABLES, reason="no supplied tables")
def test_supplied_pages_give_their_articles(spark):
    frame = spark.read.parquet(f"{FOLDER}/pages.parquet")
    found = {r.page_id: (r.text, r.n_chars) for r in extract_text(frame).collect()}
    for r in frame.collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        text = " ".join(html.unescape(re.sub(r"<[^>]*>", " ", inner)).split())
        assert found[r.page_id] == (text, len(text))


def corpus():
    rng, rows = random.Random(9), []
    words = "the and of to in is it that was for on are with as this".split()
    shared = sentence(rng, 60)
    for host in ("good", "bad"):
        for i in range(40):
            text = "\n".join(sentence(rng, rng.randint(8, 25), [*words, *(sentence(rng, 1) for _ in range(40))]) for _ in range(4))
            if host == "bad" and i < 36:
                text = "spam spam spam spam spam " * 6
            elif i % 4 == 0:
                text += "\n" + shared
            rows.append((len(rows), text, "en", host))
    base = rows[3][1].split(" ")
    rows += [(len(rows) + k, " ".join([*base[:-1], f"new{k}"]), "en", "good") for k in range(3)]
    return [*rows, (500, "12 !! 34 ++", "en", "good"), (501, None, "en", "good"), (502, "", None, None)]


def test_pipeline_stages_agree_with_brute_force(spark):
    rows = corpus()
    frame = docs(spark, rows)
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language ID", "quality rules", "line dedup", "MinHash near-dedup", "packing"]

    def texts(df):
        return {r.doc_id: r.text for r in df.collect()}

    one = stages["language ID"](spark, frame, "")
    assert one.columns == frame.columns
    assert texts(one) == {i: t for i, t, *_ in rows if i < 500}
    two = stages["quality rules"](spark, one, "")
    measured = {i: brute_measures(t) for i, t, *_ in rows if i < 500}
    good = {i for i, m in measured.items() if m[0] >= 10 and 100 * m[5] <= 20 * m[0]}
    assert two.columns == frame.columns
    assert set(texts(two)) == {i for i, _, _, host in rows if i in good and host != "bad"}
    three = stages["line dedup"](spark, two, "")
    assert three.columns == frame.columns
    assert texts(three) == brute_line_dedup(list(texts(two).items()))
    assert all(r.n_chars == len(r.text) for r in three.collect())
    four = stages["MinHash near-dedup"](spark, three, "")
    assert four.columns == frame.columns
    assert set(texts(four)) == set(brute_components(list(texts(three).items()), 5).values())
    five = stages["packing"](spark, four, "").collect()
    from tokenizers import Tokenizer

    from test_llm_tokens import check_packing

    check_packing(five, texts(four), Tokenizer.from_file(TOKENIZER), 2048)


def test_pipeline_of_an_empty_table(spark):
    df = docs(spark, [(1, "x")]).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        df = stage(spark, df, "")
    assert not df.collect()
