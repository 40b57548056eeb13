"""Quality rules, language identification and HTML extraction."""

import re
from collections import Counter
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from larderlens.llm import html_extract, language_id, quality_rules, queries


def brute_signals(text):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    n_symbols = len(re.findall("[#*$%&|<>]", text or ""))
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (len(words), sum(map(len, words)), n_symbols, len(lines) - len(set(lines)), len(covered), failed)


def signals(r):
    return (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)


@pytest.fixture(scope="module")
def rated(spark, sf):
    return queries.op1_quality_rules(spark, sf).collect()


def test_base_signals(rated, rows):
    assert {r.doc_id: signals(r) for r in rated} == {k: brute_signals(t) for k, t in rows.items()}


def test_quality_separates_rows_it_has_not_seen(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    seen = labels.where("doc_id % 2 = 0")
    rated = quality_rules.rate(docs, quality_rules.train(docs, seen)).where("NOT base_failed").select("doc_id", "kept")
    told = [(r.kept, r.quality) for r in rated.join(labels.where("doc_id % 2 = 1"), "doc_id").collect()]
    assert len(told) > 80
    assert sum(kept == (label == 1) for kept, label in told) >= 0.97 * len(told)


def test_rating_odd_documents(spark, odd, none):
    labels = spark.createDataFrame([(1, 1, 0), (8, 0, 0), (8, 1, 0), (None, 1, 0), (9, None, None)], "doc_id long, quality int, toxic int")
    for model in (quality_rules.train(odd, labels), None, quality_rules.train(none, labels), quality_rules.train(odd, labels.limit(0))):
        told = quality_rules.rate(odd, model).collect()
        texts = Counter((r.doc_id, brute_signals(r.text)) for r in odd.select("doc_id", "text").collect())
        assert Counter((r.doc_id, signals(r)) for r in told) == texts
        assert not any(r.kept for r in told if r.base_failed)
        assert quality_rules.rate(none, model).collect() == []


def test_languages_of_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    told = queries.op5_language_id(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(told) == docs.count()
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in told)
    held = [r for r in told if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held)


def test_text_is_the_only_input_of_a_prediction(documents):
    model = language_id.train(documents)
    hidden = documents.withColumns({"lang": F.lit("fr"), "source": F.lit("x"), "doc_id": F.col("doc_id") + 10**6})
    one = {r.doc_id: (r.lang_pred, r.score) for r in language_id.identify(documents, model).collect()}
    two = {r.doc_id - 10**6: (r.lang_pred, r.score) for r in language_id.identify(hidden, model).collect()}
    assert one == two


def test_languages_of_odd_documents(odd, none):
    for model in (language_id.train(odd), language_id.train(none), None):
        told = language_id.identify(odd, model).collect()
        assert len(told) == odd.count()
        assert all((r.lang_pred, r.score) == ("und", 0.0) for r in told if r.doc_id in (3, 4, 5, 8))
        assert language_id.identify(none, model).collect() == []
        kept = language_id.keep_accepted(odd, model)
        assert kept.columns == odd.columns
        assert kept.count() == sum(r.lang_pred != "und" for r in told)
    assert {r.lang_pred for r in language_id.identify(odd, language_id.train(odd)).collect()} == {"en", "und"}


def test_families_with_one_and_many_languages(spark):
    texts = {"en": "the cat and the dog", "de": "der hund und die katze", "nl": "de hond en het katje", "xx": "zzq qqz zqz"}
    rows = [(n, f"{t} {n % 5}", lang) for lang, t in texts.items() for n in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    told = language_id.identify(docs, language_id.train(docs)).join(docs, "doc_id").select("lang_pred", "text").distinct().collect()
    assert {r.lang_pred for r in told} == set(texts)


# Pages


def page_blocks(page):
    article = re.search("<article>(.*)</article>", page, re.DOTALL)[1]
    import html

    blocks = (re.sub("<[^>]+>", "", b.replace("<br>", " ")) for b in re.split("</?(?:p|h1)>", article))
    return [" ".join(html.unescape(b).split()) for b in blocks]


def test_articles_of_all_pages(spark, sf):
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    told = queries.op7_html_extraction(spark, sf).collect()
    assert len(told) == len(pages)
    for r in told:
        assert r.text == "\n".join(filter(None, page_blocks(pages[r.page_id].html)))
        assert (r.n_chars, r.url) == (len(r.text), pages[r.page_id].url)


PROSE = "A sentence with some words, and a clause. Another one follows it, quite long, to be read."


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("plain text &amp; more", "plain text & more"),
        ("<nav><a>Home</a></nav><footer>x</footer>", ""),
        (f"<div id=main-col><h2>Title</h2><p>{PROSE}<p>{PROSE}</div><div class='side sidebar'><p>{PROSE}</p></div>", f"Title\n{PROSE}\n{PROSE}"),
        (f"<body><article><p>{PROSE}</p><ul><li>one<li>two</ul></article><section id=comments><article><p>{PROSE}</p></article></section>", f"{PROSE}\none\ntwo"),
        (f"<article><p>{PROSE}<script>if (a<b) '</p>'</script></p><form><p>mail</p></form><p>a&nbsp;&#233;<b>b</b> <i>c</i></article>", f"{PROSE}\na éb c"),
        (f"<body class='has-sidebar'><div class='page header-on widget'><article><p>{PROSE}</article></div>", PROSE),
        (f"<main><p>{PROSE}</p><p hidden>no</p><div style='display: none'>no</div><aside>no</aside></main><!-- <p>{PROSE}</p>", PROSE),
        (f"<table><tr><td><p>{PROSE}</p></td></tr></table><div role=navigation>{PROSE}</div>", PROSE),
        (f"<div><p>{PROSE}</p></nav></section><a href='<p>x</p>'>link</a> &lt;b&gt;</div>", f"{PROSE}\nlink <b>"),
    ],
)
def test_page_forms(page, text):
    assert (html_extract.main_text(page) if page is not None else "") == text


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (f"<article class='post comments-open'><h1>Title</h1><p>{PROSE}</article>", f"Title\n{PROSE}"),
        (f"<form><article class='post comments-open'><p>{PROSE}</article></form>", PROSE),
        (f"<div class='post comments-open'><p>{PROSE}<p>{PROSE}</div><div>a note</div>", f"{PROSE}\n{PROSE}"),
        (f"<nav>{PROSE * 9}</nav><div class='content has-sidebar'><p>{PROSE}</p></div>", PROSE),
        (f"<div class='content no-sidebar'><p>{PROSE}</p><div class=sidebar><p>{PROSE}</p></div></div>", PROSE),
        (f"<div class='share-enabled'><p>{PROSE}</p></div><div class='site-footer'>Text.</div>", PROSE),
        (f"<section class='legal-analysis'><p>{PROSE}</p></section>", PROSE),
        # Comments that are longer than the article stay out.
        (f"<div><p>{PROSE}</div><div id=comments><p>{PROSE * 9}</div>", PROSE),
        (f"<main><p>{PROSE}</main><div class=comment-list><p>{PROSE * 9}</div>", PROSE),
        (f"<div class=has-sidebar><p>{PROSE}<div class=comments><p>{PROSE * 9}</div></div>", PROSE),
        ("<div class='menu-bar'>Home</div><div class=sidebar>News</div>", ""),
    ],
)
def test_words_in_class_or_id_do_not_remove_the_article(page, text):
    assert html_extract.main_text(page) == text


def test_odd_pages(spark):
    rows = [(1, "u", None), (2, None, ""), (None, "u", f"<p>{PROSE}"), (3, "u", "<div>" * 20000 + "x"), (3, "u", "<div>" * 20000 + "x")]
    rows += [(4, "u", "<a href=\"" * 5000), (5, "u", "<p " * 5000), (6, "u", "<!--" * 5000), (7, "u", "<script>" * 5000 + "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"text": F.lit(1), "n_chars": F.lit("x")})
    told = [(r.page_id, r.url, r.text, r.n_chars) for r in html_extract.extract(pages).collect()]
    assert (1, "u", "", 0) in told and (2, None, "", 0) in told and (None, "u", PROSE, len(PROSE)) in told
    assert told.count((3, "u", "x", 1)) == 2 and len(told) == len(rows)
    assert html_extract.extract(pages.limit(0)).collect() == []


def test_every_language_is_learned_from_a_bounded_sample(spark, monkeypatch):
    rows = [(n, f"l{n % 300:03}", f"text {n} of words") for n in range(2000) if crc32(str(n).encode()) % 3 != 1]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    languages = {r[1] for r in rows}
    assert {r.lang for r in language_id._sample(docs).collect()} == languages
    monkeypatch.setattr(language_id, "SAMPLE_ROWS", 600)
    few = language_id._sample(docs).groupBy("lang").count().collect()
    assert {r.lang for r in few} == languages and max(r["count"] for r in few) <= 2
