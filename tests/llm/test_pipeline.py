"""The five stages one after the other."""

from collections import Counter

import corpus_pipeline
from brute import brute_pipeline
from oracle_check import compare, connect

import __spark_entry__
from larderlens.llm.common import settle
from larderlens.llm.oracle import ORACLE


def test_every_stage_on_odd_and_no_documents(spark, odd, none, sf):
    for docs in (odd, none):
        for name, stage in corpus_pipeline.STAGES:
            before, docs = docs, settle(stage(spark, docs, sf), f"test-{name}")
            if name != corpus_pipeline.STAGES[-1][0]:
                assert docs.columns == before.columns and docs.count() <= before.count()
        assert {"doc_id", "sequence_id", "offset"} <= set(docs.columns)


def test_texts_of_no_sure_language_go(spark, sf):
    english = ["the house by the river was sold with all that was in it", "they have shown that this is what she would have thought"]
    german = ["das haus am fluss wurde mit allem verkauft was darin war", "sie haben gezeigt dass sie das nicht gedacht hätten"]
    rows = [(n, f"{text} {n}", lang) for n in range(40) for lang, texts in (("en", english), ("de", german)) for text in texts]
    # A text that four languages have alike is none of them for sure.
    rows += [(1000 + n, text, lang) for n in range(40) for lang, text in (("en", "xq"), ("fr", "xq"), ("es", "xq"), ("de", "xq"))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    left = corpus_pipeline.accept_language(spark, docs, sf)
    assert left.where("text = 'xq'").count() == 0
    assert left.where("text <> 'xq'").count() == docs.where("text <> 'xq'").count()


def test_run_equals_brute_force(spark, sf, rows):
    told = corpus_pipeline.run(spark, sf).collect()
    want = brute_pipeline(rows)
    assert Counter((r.doc_id, r.piece, r.length, r.ids_crc32) for r in told) == want


def test_every_operator_has_its_query():
    names = __spark_entry__.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13
    assert names["pipeline"] is corpus_pipeline.run


def test_queries_equal_their_sql(spark, sf):
    for name, sql in ORACLE.items():
        assert compare(spark, connect(sf), sf, __spark_entry__.queries()[name], sql) is None
