"""HTML extraction, chat formatting and the pipeline."""

import hashlib
import html
import random
import re
import time

import duckdb
import pytest

import corpus_pipeline
from tallyward.llm import chat_format, html_extract
from tallyward.llm.queries import ORACLE_SQL, QUERIES


def test_articles_of_the_test_pages(table):
    rows = {row["page_id"]: row for row in html_extract.extract_text(table("pages")).collect()}
    for page in table("pages").collect():
        body = re.search("<article>(.*)</article>", page["html"], re.S)[1]
        blocks = re.sub("<[^>]*>", "", re.sub("</?(p|h1|br)>", "\0", body)).split("\0")
        lines = [" ".join(html.unescape(block).split()) for block in blocks]
        text = "\n".join(line for line in lines if line)
        assert rows[page["page_id"]]["text"] == text
        assert rows[page["page_id"]]["n_chars"] == len(text)


@pytest.mark.parametrize(
    "page, text",
    [
        ("", ""),
        ("plain  text", "plain text"),
        ("<p>a<p>b", "a\nb"),
        ("a<!-- c -->b &#39;&lt;p&gt;<script>x<p>y</script>t", "ab '<p>t"),
        ("<article><header><h1>T</h1></header><p>x  y\n z</p><aside>no</aside><form>f</form></article>", "T\nx y z"),
        ("<div id=sidebar>menu</div><div><p>A long enough text here<p>Short.<div class='comments'><p>c</div></div>",
         "A long enough text here\nShort."),
        ("<div class='cookie-notice'>We use cookies, a lot of them</div><main><p>Text</main><footer>f", "Text"),
    ],
)
def test_small_pages(page, text):
    assert html_extract.main_text(page) == text


@pytest.mark.parametrize(
    "page, lines",
    [
        ("<div><section>{0}</section><section>{1}</section></div>", 2),
        ("<div><section>{0}{0}{0}{0}{0}{0}</section><p>{1}</p></div>", 7),
        ("<body><div>{0}</div><div>{1}</div></body>", 2),
        ("<table><tr><td>{0}</td><td>{1}</td></tr></table>", 2),
        ("<article>Short one.</article><div>{0}{0}</div>", 0),
    ],
)
def test_articles_over_several_elements(page, lines):
    texts = ["some words of the first " * 12, "and more of the second " * 11]
    wanted = [" ".join((texts[0] * max(1, lines - 1)).split()), texts[1].strip()] if lines else ["Short one."]
    assert html_extract.main_text(page.format(*texts)) == "\n".join(wanted)


@pytest.mark.parametrize(
    "page, text",
    [
        ("<html><head><title>t</title><body><p>Some text", "Some text"),
        ("<head><meta charset=x><title>t</title><p>Some text", "Some text"),
        ("<div class='page has-sidebar'><article><p>Some text</article></div>", "Some text"),
        ("<div class='menu'><main><article><p>Some text</article></main></div>", "Some text"),
        ("<body><form><div>Some text of a page</div></form></body>", "Some text of a page"),
        ("<article><div class='post-header'>Title</div><p>Text<div class='tags'>x</div></article>", "Title\nText\nx"),
        ("<article><p>Text</article><article class='comment'><p>No</article>", "Text"),
        ("<article><p>Text</article><div class='related'><article>No</article></div>", "Text"),
    ],
)
def test_dropping_spares_what_holds_the_article(page, text):
    assert html_extract.main_text(page) == text


PROSE = "A long sentence of the real article that goes on for quite a while, with many words. " * 3
P = f"<p>{PROSE}</p>"


@pytest.mark.parametrize(
    "page, text",
    [
        # An article's own parts under telling names.
        (f"<article>{P}<section id='discussion'>{P}</section></article>", "P P"),
        (f"<article><h2 id='search-algorithms'>Search</h2>{P}<h2 id='related-work'>Work</h2>{P}</article>", "Search P Work P"),
        (f"<article>{P}<p class='share-price'>Up</p><div class='form-factor'>Small</div></article>", "P Up Small"),
        (f"<main><header><h1>Title</h1></header>{P}</main>", "Title P"),
        (f"<article>{P}<aside class='pullquote'>Quoted</aside></article>", "P Quoted"),
        (f"<article>{P}<div class='market-banner'>{P}</div></article>", "P P"),
        # What is not the article's, beside it and in it.
        (f"<article>{P}</article><article class='related'>{P}</article><article class='promo ad'>{P}</article>", "P"),
        (f"<article class='promo'>{P}</article>", "P"),
        (f"<article>{P}<section id='comments'>{P}</section><div class='comment-list'>{P}</div></article>", "P"),
        (f"<article>{P}<div class='newsletter'>{P}</div><div class='blog-newsletter'><a href=x>Join us</a></div></article>", "P"),
        (f"<main>{P}<div class='related-posts'>{P}</div><div hidden>{P}</div></main>", "P"),
        # No element around the article alone.
        (f"<body><div>{PROSE}</div><div>Copyright</div></body>", "P"),
        (f"<body><p>Menu<p><a href=x>One two three</a><h1>Title</h1><p>{PROSE}<p>{PROSE}<p>Imprint</body>", "Title P P"),
        (f"<div class='menu'><div class='ad'><article>{P}</article></div><article>{P}</article><div class='ad'><article>{P}</article></div></div>", "P"),
    ],
)
def test_names_and_ratios(page, text):
    assert html_extract.main_text(page) == "\n".join(PROSE.strip() if word == "P" else word for word in text.split())


def test_pages_without_a_holder_against_what_they_were_made_of():
    dice = random.Random(6)
    for _ in range(150):
        article = [" ".join(dice.choices(PROSE.split(), k=dice.randint(30, 80))) for _ in range(dice.randint(2, 6))]
        blocks = [f"<p>{each[:20]}<b>{each[20:40]}</b>{each[40:]}</p>" for each in article]
        around = [
            "<ul class='nav-menu'>" + "<li><a href=x>Page one</a>" * 5 + "</ul>", "<div id=sidebar><p>Other things</p></div>",
            f"<div class='comments-area'><p>{PROSE}</p></div>", "<footer><p>All rights</footer>", "<form><input><label>Mail</form>",
            f"<div role=complementary>{PROSE}</div>", "<script>var a = '<p>';</script>", "<div class='cookie-consent'>We use them</div>",
        ]
        dice.shuffle(around)
        cut = dice.randint(0, len(around))
        body = dice.choice(["<div class='page'>{}</div>", "<section>{}</section>", "<table><tr><td>{}</td></tr></table>"])
        html_text = f"<html><head><title>T</title></head><body>{''.join(around[:cut])}{body.format(''.join(blocks))}{''.join(around[cut:])}"
        assert html_extract.main_text(html_text) == "\n".join(article)


@pytest.mark.parametrize(
    "page",
    [
        "<div>" * 50_000 + "x", "<figure>" * 50_000 + "x", "<b>" * 50_000 + "</i>" * 50_000 + "x", "<p>" * 50_000 + "x",
        "<div class=form>" * 50_000 + "x", "<div class=form>" * 60 + "<p>x</p>" * 20_000, "<li><span>" * 25_000 + "x",
    ],
)
def test_deep_and_long_pages(page):
    start = time.process_time()
    assert html_extract.main_text(page).startswith("x")
    assert time.process_time() - start < 5


def test_pages_with_nulls(spark, table):
    odd = table("pages").selectExpr("*", "'x' AS `meta.lang`", "map('a', 1) AS text", "1 AS c0")
    assert sorted(html_extract.extract_text(odd).collect()) == sorted(html_extract.extract_text(table("pages")).collect())
    pages = spark.createDataFrame([(1, None, None), (None, "u", "<p>x"), (1, None, None)], "page_id long, url string, html string")
    found = html_extract.extract_text(pages).collect()
    assert sorted((r["page_id"] or 0, r["text"], r["n_chars"]) for r in found) == [(0, "x", 1), (1, "", 0), (1, "", 0)]
    assert html_extract.extract_text(pages.limit(0)).count() == 0


def test_every_text_comes_back():
    dice = random.Random(2)
    parts = ["<", "|", "\\", "im_start", "im_end", "|>", "\n", "a", "<|im_end|>", "<|im_start|>", "assistant"]
    for _ in range(5000):
        role, text = ("".join(dice.choices(parts, k=dice.randint(0, n))) for n in (4, 9))
        segment, start, end = chat_format.render(role, text)
        assert chat_format.parse(segment) == [(role, text)]
        assert chat_format.unescape(segment[start:end]) == text
    assert chat_format.render("user", "<b| x")[0] == "<|im_start|>user\n<b| x<|im_end|>\n"
    with pytest.raises(ValueError):
        chat_format.parse("<|im_start|>user\nno end")


def test_conversations_with_nulls_ties_and_length(spark, table):
    rows = [(1, 0, "user", None), (1, 1, "assistant", "x"), (1, 1, "assistant", "x"), (2, None, None, "<|im_end|>"), (None, 0, "assistant", "n")]
    rows += [(4, 0, "assistant", "a long turn <|im_end|> " * 200_000), (5, 0, "a", "b\nc"), (5, 0, "a\nb", "c"), (5, 0, "a b", "")]
    rows += [(3, n, "assistant" if n % 2 else "user", f"turn {n}") for n in range(25_000)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    odd = turns.selectExpr("*", "1 AS segment", "2 AS start", "map('a', 1) AS `meta.x`")
    found = {r["conv_id"]: r for r in chat_format.read_back(chat_format.format_turns(odd)).collect()}
    assert sorted(map(tuple, found.values()), key=str) == sorted(
        map(tuple, chat_format.read_back(chat_format.format_turns(turns)).collect()), key=str
    )
    assert found[4]["loss_chars"] == len("a long turn <|im_end|> ") * 200_000 and found[5]["n_turns"] == 3
    assert found[1]["n_turns"] == 3 and found[1]["loss_chars"] == 2
    assert found[2]["turns_sha256"] == hashlib.sha256(b"\n<|im_end|>\n").hexdigest()
    assert found[None]["loss_sha256"] == hashlib.sha256(b"n").hexdigest()
    long = "".join(f"{role}\n{text}\n" for conv, _, role, text in rows if conv == 3)
    assert found[3]["turns_sha256"] == hashlib.sha256(long.encode()).hexdigest()
    assert chat_format.read_back(chat_format.format_turns(turns.limit(0))).count() == 0


def test_chat_query_equals_its_sql(spark, sf_dir):
    found = sorted(map(tuple, QUERIES["op2_chat_format"](spark, sf_dir).collect()))
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW conversations AS SELECT * FROM '{sf_dir}/conversations.parquet'")
        assert found == sorted(db.execute(ORACLE_SQL["op2_chat_format"]).fetchall())


def test_pipeline(spark, sf_dir, table):
    """Each stage against its operator over what the stage before kept."""
    docs = table("documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, sf_dir)
        assert after.columns == docs.columns, name
        ids = [row["doc_id"] for row in after.select("doc_id").collect()]
        assert set(ids) <= {row["doc_id"] for row in docs.select("doc_id").collect()}
        assert len(ids) == len(set(ids))
        docs = after
    found = corpus_pipeline.run(spark, sf_dir)
    assert sorted(row["doc_id"] for row in found.collect()) == sorted(ids)
    assert not [row for row in docs.collect() if "@mail" in row["text"]]
