"""Stages on rows that repeat ids, have none, or differ in case only."""

from __future__ import annotations

import collections
import time

import pytest

pytest.importorskip("dockhand.llm")

from dockhand.llm import exact_dedup, mixing, near_dedup, pages, secrets  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, keep_id long, size long, hash string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, 0, 7, 8, "clash") for i, t, s in rows], SCHEMA).repartition(3)


def test_each_text_stays_once(spark):
    rows = [(0, "same", "a"), (1, "same", "a"), (1, "other", "a"), (None, "lost one", "a"), (None, "lost two", "b"), (None, "lost  two", "b")]
    rows += [(4, "twice", "b"), (4, "twice", "a"), (5, None, "a"), (6, "", "a"), (None, "same", "c")]
    df = frame(spark, rows)
    got = exact_dedup.drop_copies(df)
    assert got.columns == df.columns
    kept = sorted(((r["doc_id"], " ".join((r["text"] or "").split()), r["source"]) for r in got.collect()), key=str)
    assert kept == sorted([(0, "same", "a"), (1, "other", "a"), (None, "lost one", "a"), (None, "lost two", "b"), (4, "twice", "a"), (5, "", "a")], key=str)
    assert exact_dedup.drop_copies(df.limit(0)).collect() == []


def test_the_mix_holds_rows_without_and_with_one_id(spark):
    rows = [(None, "one two three", "a"), (None, "four five", "a"), (1, "six seven", "a"), (1, "eight nine ten eleven", "a"), (2, "a " * 30, None)]
    df = frame(spark, rows)
    plan = mixing.mixture(df).collect()
    want = collections.Counter()
    for r in plan:
        want[r["doc_id"]] += r["taken"]
    got = collections.Counter()
    for r in mixing.mixed_documents(df).collect():
        got[r["doc_id"]] += len(r["text"].split())
    assert got == want and {r["size"] for r in plan} == {3, 2, 4, 30}


def test_contexts_in_any_case():
    ranks = secrets.dictionary(None) if hasattr(secrets, "dictionary") else {}
    lower, upper = (secrets.guess_spans(t, ranks) for t in ("the password is Zk8qLw92Tx", "THE PASSWORD IS Zk8qLw92Tx"))
    assert lower == upper == [("guess", 16, 26)]


def near_by_force(rows):
    """First row of each row's component, links by plain comparison of all four-word shingles."""
    sets = [frozenset(tuple(w[k : k + 4]) for k in range(max(1, len(w) - 3))) if (w := (t or "").lower().split()) else frozenset() for _, t, _ in rows]
    at = list(range(len(rows)))
    for _ in rows:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if rows[i][0] is not None and rows[j][0] is not None and a and 100 * len(a & b) >= 80 * len(a | b):
                    at[i] = at[j] = min(at[i], at[j])
    least = {}
    for i, row in enumerate(rows):
        least[at[i]] = min(least.get(at[i], row[0]), row[0]) if row[0] is not None else None
    return [(row[0], len(s), least[at[i]]) for i, (row, s) in enumerate(zip(rows, sets, strict=True))]


def test_near_copies_of_texts_that_share_an_id(spark):
    """Every text under one id meets its own near copies, and none hides another."""
    long = [" ".join(f"w{n}x{i}" for i in range(200)) for n in range(6)]
    rows = [(1, t, "a") for t in long] + [(2 + n, t + " tail", "a") for n, t in enumerate(long)]
    rows += [(9, long[0] + " end", "b"), (9, "a text of its own here", "b"), (9, "a text of its own here", "b"), (9, None, "b"), (None, long[0], "b"), (0, long[5] + " x", "c")]
    df = frame(spark, rows)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in near_dedup.near_groups(df).collect()), key=str)
    assert got == sorted(near_by_force(rows), key=str)
    assert (0, 198, 0) in got and got.count((1, 197, 1)) == 5 and (1, 197, 0) in got and got.count((9, 3, 9)) == 2
    kept = near_dedup.drop_near_copies(df)
    assert kept.columns == df.columns
    ids = collections.Counter(r.doc_id for r in kept.collect())
    assert ids == {1: 5, 9: 3, None: 1, 0: 1}
    assert near_dedup.drop_near_copies(df.limit(0)).count() == 0


def test_of_near_copies_under_one_id_one_stays(spark):
    text = " ".join(f"w{i}" for i in range(200))
    rows = [(4, text + f" end{n}", "a") for n in range(5)] + [(5, text, "a")]
    kept = near_dedup.drop_near_copies(frame(spark, rows)).collect()
    assert [r.doc_id for r in kept] == [4]


@pytest.mark.parametrize(
    ("html", "want"),
    [
        ('<div class="layout has-sidebar"><article><p>A long text.</p></article><div class="sidebar">side</div></div>', "A long text."),
        ('<div class="content no-ads"><p>A long text.</p><div class=ads>Buy</div></div>', "A long text."),
        ('<article><div class="entry-header"><h1>Head</h1></div><p>Body.</p></article>', "Head\nBody."),
        ('<main><p>First.</p><section id="related-work"><p>Others.</p></section><div class=related><a href=x>more</a> teaser</div></main>', "First.\nOthers."),
        ("<div class=widget><p>" + "word " * 50 + "</p><div class=comments>" + "reply " * 500 + "</div></div><div>Home</div>", ("word " * 50).strip()),
        ("<div class=post><p>short one</p></div><div class=comments>" + "reply " * 500 + "</div>", "short one"),
        ("<article><p>short one</p></article><div class=widget>" + "word " * 500 + "</div>", "short one"),
        ("<div class=comments><p>all there is</p></div>", "all there is"),
        ("<div class='banner'><main><p>the longer text</p></main></div><p>other</p>", "the longer text"),
        ("<nav>menu</nav>", ""),
    ],
)
def test_marks_are_weighed(html, want):
    assert pages.extract(html, None) == want


def test_the_path_of_the_host_decides(spark):
    """A page holds its host's path and one that it would choose itself."""
    usual = "<body><div class=story><p>{}</p></div><div class=extra><p>note</p></div></body>"
    odd = "<body><div class=story><p>short</p></div><div class=extra><p>" + "more words " * 30 + "</p></div></body>"
    rows = [(i, f"http://one/{i}", usual.format(f"the text of page {i} " * 9)) for i in range(5)] + [(5, "http://one/5", odd), (6, "http://two/", odd)]
    got = {r.page_id: r.text for r in pages.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[5] == "short" and got[0] == ("the text of page 0 " * 9).strip()
    assert got[6] == pages.extract(odd, None) != "short"


@pytest.mark.parametrize("unit", ["<b>x</i>", "<div>", "<td><b>x", "<p><b><li>", "<div class=sidebar>x", "</div><main>"])
def test_reading_a_page_is_linear(unit):
    start = time.process_time()
    pages.extract("<p>" + unit * 40_000 + "end", None)
    assert time.process_time() - start < 20
