from __future__ import annotations

import html
import html.entities
import re
from collections import Counter
from os.path import splitext

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dockhand.functions import crypto, markup, paths, text, values
from dockhand.operators import enrich, language, search
from dockhand.plans.oracle import ORACLE_SQL

NAMES = ["a.tar.gz", ".bashrc", "..a.b", "a.", "noext", "x.PDF", "...", "", ".", "a.b.", "..a", "a b.c d"]


def column(spark, items, expression):
    """Values of an expression over ``t``, in order."""
    df = spark.createDataFrame(list(enumerate(items)), "i int, t string")
    return [r[1] for r in sorted(df.select("i", expression).collect())]


def test_white_space_is_pythons(spark):
    marks = [chr(c) for c in range(1, 0x3100) if not 0xD800 <= c < 0xE000]
    counts = column(spark, [f"a{c}b" for c in marks], text.word_count(F.col("t")))
    assert counts == [len(f"a{c}b".split()) for c in marks]
    assert column(spark, marks, text.strip(F.col("t"))) == [c.strip() for c in marks]


def test_splitext_is_pythons(spark):
    assert column(spark, NAMES, paths.stem(F.col("t"))) == [splitext(n)[0] for n in NAMES]
    assert column(spark, NAMES, paths.extension(F.col("t"))) == [splitext(n)[1] for n in NAMES]


def test_accepted_extensions(spark):
    names = ["/a/x.PDF", "/a/x.exe", "/a/.pdf", "/a.pdf/x", "x.tar.gz", "y.Html"]
    assert column(spark, names, paths.has_accepted_extension(F.col("t"))) == [True, False, False, False, False, True]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="abé A.\n", max_size=60), min_size=1, max_size=30))
def test_term_counts_and_keywords(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r.doc_id: r for r in enrich.top_keywords(
        text.with_term_counts(df, text.tokens(F.col("text")), "terms")).collect()}
    stop = set(text.all_stop_words())
    for i, t in enumerate(texts):
        words = re.findall(r"[^\W\d_]+", t.lower())
        assert [(e.term, e.n) for e in got[i].terms] == sorted(Counter(words).items())
        ranked = sorted(((-n, w) for w, n in Counter(words).items() if w not in stop))[:10]
        assert got[i].keywords == [w for _, w in ranked]


def test_long_repetition_does_not_recurse(spark):
    df = spark.range(1).select(F.repeat(F.lit("the cat "), 100_000).alias("text"))
    row = text.with_term_counts(df, text.tokens(F.col("text")), "terms").first()
    assert [(e.term, e.n) for e in row.terms] == [("cat", 100_000), ("the", 100_000)]


def test_large_single_run(spark):
    """10 MB of one letter passes through stats and entities."""
    df = spark.range(1).select(F.repeat(F.lit("A"), 10_000_000).alias("content"))
    row = enrich.extract_entities(enrich.content_stats(df), "content").drop("content").first()
    assert (row.content_length, row.word_count, row.entities) == (10_000_000, 1, [])


def test_entities(spark):
    df = spark.createDataFrame([("PN-12 cost $3.50 on 2024-01-31, see https://a.b/c or x@y.org",), (None,), ("é",)], "text string")
    found = [[(e.label, e.text) for e in r.entities] for r in enrich.extract_entities(df).collect()]
    assert found[0] == [
        ("EMAIL", "x@y.org"), ("URL", "https://a.b/c"), ("DATE", "2024-01-31"), ("MONEY", "$3.50"), ("PART_NO", "PN-12"),
        ("CARDINAL", "12"), ("CARDINAL", "3"), ("CARDINAL", "50"), ("CARDINAL", "2024"), ("CARDINAL", "01"), ("CARDINAL", "31"),
    ]
    assert found[1:] == [[], []]
    short = enrich.extract_entities(df, max_chars=5).first()
    assert [(e.label, e.text) for e in short.entities] == [("PART_NO", "PN-12"), ("CARDINAL", "12")]


def test_html(spark):
    page = (
        '<!DOCTYPE html><html class="x" lang="de"><head><title> A &amp;lt; B </title><style>p{}</style>'
        '<script>var t="</p>";</script></head><body><!-- <b>no</b> --><p>1 < 2 &amp;&nbsp;x<br>y</p></body></html>'
    )
    df = spark.createDataFrame([(page,)], "html string")
    row = df.select(markup.html_text(F.col("html")).alias("t"), markup.html_metadata(F.col("html")).alias("m")).first()
    assert row.t == "A &lt; B 1 < 2 & x y"
    assert row.m == {"title": "A &lt; B", "lang": "de"}


HARD_HTML = [
    ("a<script>x<b>no</b>", "a"),
    ("a<STYLE>p{}</style x>b<script src='>'>no</script >c", "a b c"),
    ("&#x2019;&eacute;&#233;&Eacute;&bogus; &amp;lt; &amp;#65; &#65 &&&amp", "\u2019\xe9\xe9\xc9&bogus; &lt; &#65; &#65 &&&amp"),
    ("&#0;&#xD800;&#x110000;&#9999999;&#128;&#8364;&#x1F600;&#0000065;a&nbsp;&#160;b", "\ufffd" * 4 + "\u20ac\u20ac\U0001f600Aa b"),
    ("<a title=\"a>b\" rel='c>d'>e</a>", "e"),
    ("<a title=\"x>y", "y"),
    ("<p it's>z</p>&apos;", "z '"),
    ("x<!-- a > b", "x"),
    ("x<!-- <script> -->y<?php z ?>&", "x y &"),
    ("1 < 2 <3 <", "1 < 2 <3 <"),
    ("<a href=x", ""),
    ("", ""),
    (None, None),
]


def test_unclosed_parts_quotes_and_references(spark):
    assert column(spark, [h for h, _ in HARD_HTML], markup.html_text(F.col("t"))) == [t for _, t in HARD_HTML]
    duck = duckdb.connect()
    duck.execute("CREATE TABLE pages (page_id BIGINT, html VARCHAR)")
    duck.executemany("INSERT INTO pages VALUES (?, ?)", [(i, h) for i, (h, _) in enumerate(HARD_HTML)])
    rows = duck.sql(f"SELECT page_id, content FROM ({ORACLE_SQL['extract_html_text']})").fetchall()
    assert [content for _, content in sorted(rows)] == [t for _, t in HARD_HTML]


def test_references_are_pythons(spark):
    numbers = [*range(32, 127), *range(128, 160), *range(161, 0x3000, 37), 0xD7FF, 0xD800, 0xDFFF, 0xE000, 0x10FFFD, 0x110000, 0]
    items = [f"x&#{n};y" for n in numbers] + [f"x&#x{n:X};" for n in numbers] + [f"&{n};&{n};" for n in html.entities.name2codepoint]
    got = column(spark, items, markup.unescape(F.col("t")))
    assert got == [html.unescape(i).replace("\xa0", " ") for i in items]


def test_odd_pages_take_one_scan(spark):
    pages = ["<a " + "x='1' " * 30_000 + ">k", "<a " + "b=" * 100_000 + ">k", "<script>" * 20_000, "<" * 100_000, '<a t="' * 20_000, "&#65;" * 20_000]
    lengths = column(spark, pages, F.length(markup.html_text(F.col("t"))))
    assert lengths == [1, 1, 0, 100_000, 0, 20_000]


def test_language_gate_and_undecided(spark):
    docs = spark.createDataFrame(
        [("the cat sat on the mat", "en"), ("der Hund ist in der Hütte", "de")], "text string, lang string"
    )
    profile = language.train_profile(docs)
    tested = spark.createDataFrame(
        [(0, "the dog on the mat"), (1, "der Hund und der Kater"), (2, "  the  the \n"), (3, "12345 67890 123"), (4, None),
         (5, "hunden katzen")], "i int, text string",
    )
    got = {r.i: r.language for r in language.detect_language(tested, profile).collect()}
    assert got == {0: "en", 1: "de", 2: None, 3: "und", 4: None, 5: "de"}


def test_language_accuracy(spark, checked):
    docs = spark.read.parquet(f"{checked}/documents.parquet")
    rows = language.cross_validated_accuracy(docs).collect()
    assert sum(r.n_right for r in rows) / sum(r.n_texts for r in rows) > 0.99


def test_too_many_languages_are_refused(spark):
    many = spark.createDataFrame([(f"l{i}", "word", "x") for i in range(201)], "lang string, kind string, entry string")
    try:
        language.load_profiles(many, F.lit(0))
        raise AssertionError("expected a refusal")
    except ValueError:
        pass


def test_json_and_maps(spark):
    df = spark.createDataFrame([('{"color":"red","n":{"x":1}}',), ("no json",), (None,)], "t string")
    rows = df.select(values.json_path_text(F.col("t"), "$.color"), values.json_path_text(F.col("t"), "$.n")).collect()
    assert [tuple(r) for r in rows] == [('"red"', '{"x":1}'), (None, None), (None, None)]
    a = F.create_map(F.lit("a"), F.lit(1), F.lit("b"), F.lit(2))
    b = F.create_map(F.lit("b"), F.lit(3))
    row = spark.range(1).select(values.merge_maps(a, b).alias("m"), values.map_value(F.create_map(F.lit("k"), F.lit("v")), "z", "d").alias("d")).first()
    assert row.m == {"a": 1, "b": 3} and row.d == "d"


def test_slices(spark):
    for n in (0, 3, 10, 11):
        items = F.array(*[F.lit(i) for i in range(n)]).cast("array<int>")
        row = spark.range(1).select(values.head(items, 10), values.tail(items, 10)).first()
        assert list(row) == [list(range(n))[:10], list(range(n))[-10:]]


def test_time_texts(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2024-01-05 03:04:05' AS a, TIMESTAMP_NTZ '2024-01-05 03:04:05.000120' AS b")
    a, b = F.col("a"), F.col("b")
    row = df.select(paths.compact_time(a), paths.log_time(a), paths.iso_time(a), paths.iso_time(b), paths.ctime_text(a)).first()
    assert list(row) == [
        "20240105_030405", "2024-01-05_03-04-05", "2024-01-05T03:04:05", "2024-01-05T03:04:05.000120", "Fri Jan  5 03:04:05 2024",
    ]


def test_encryption_hides_and_returns(spark):
    key = F.lit("0123456789abcdef")
    df = spark.createDataFrame([("secret",), ("",), (None,)], "t string")
    rows = df.withColumn("c", crypto.encrypt_text(F.col("t"), key)).withColumn("d", crypto.decrypt_text(F.col("c"), key)).collect()
    assert [r.d for r in rows] == ["secret", "", None]
    assert all("secret" not in r.c for r in rows if r.c)


def test_index_and_search(spark, tmp_path):
    docs = spark.createDataFrame([(1, "red gear red"), (2, "gear box"), (3, "box")], "doc_id int, text string")
    path = str(tmp_path / "index")
    search.write_index(search.postings(docs), path)
    index = spark.read.parquet(path)
    assert sorted(tuple(r) for r in index.collect()) == [("box", 2, 1), ("box", 3, 1), ("gear", 1, 1), ("gear", 2, 1), ("red", 1, 2)]
    n_docs = docs.agg(F.count(F.lit(1)).alias("n_docs"))
    found = search.search(index, n_docs, ["RED", "gear"], 5).collect()
    assert [r.doc_id for r in found] == [1, 2]
    plan = search.matching(index, ["red"])._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(term" in plan or "EqualTo(term" in plan
