"""Text expressions: strip, counts, tokens, in-row term counts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the characters a text counts as white space for strip and
# word split (Unicode white space plus the four ASCII separators), as the
# inside of a character class.
WHITESPACE = (
    r"\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
WHITESPACE_CHARACTERS = "".join(
    chr(code)
    for first, last in [
        (0x09, 0x0D), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A),
        (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000),
    ]
    for code in range(first, last + 1)
)

# The same set by property, which the matcher tests far faster than by ranges.
BLANKS = r"(?U)[\s\x1c-\x1f]+"
NON_BLANKS = r"(?U)[^\s\x1c-\x1f]+"

# The most common function words of the four languages handled.
STOP_WORDS = {
    "en": (
        "a an and are as at be but by for from had has have he her his in is it "
        "its not of on or she that the their this to was were which will with you"
    ).split(),
    "fr": (
        "au aux avec ce ces dans de des du elle en est et il la le les mais ne "
        "nous on ou par pas pour que qui sa se son sur un une vous"
    ).split(),
    "de": (
        "als an auch auf aus bei das dem den der des die ein eine einer er es für "
        "im in ist mit nach nicht sich sie und von war wird zu zum zur"
    ).split(),
    "es": (
        "al como con de del el en es esta la las lo los más no o para pero por "
        "que se sin su sus un una y"
    ).split(),
}


def all_stop_words() -> list[str]:
    """Stop words of every language, each once, sorted."""
    return sorted({word for words in STOP_WORDS.values() for word in words})


def strip(text: Column) -> Column:
    """Drop leading and trailing white space of any kind (``trim`` drops blanks only)."""
    return F.btrim(text, F.lit(WHITESPACE_CHARACTERS))


def word_count(text: Column) -> Column:
    """Number of white-space separated words; 0 for an empty text."""
    return F.regexp_count(text, F.lit(NON_BLANKS))


def tokens(text: Column) -> Column:
    """Lower-case runs of letters, in text order."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}+"), F.lit(0))


def trigrams(text: Column) -> Column:
    """Overlapping lower-case character trigrams, one linear pass over the text."""
    return F.regexp_extract_all(F.lower(text), F.lit("(?s)(?=(...))"), F.lit(1))


# A word and its repetitions in a blank-separated sorted list. The possessive
# quantifier makes the matcher loop instead of recursing, so a word may repeat
# any number of times.
_RUN = r"([^ ]+)(?: \1(?![^ ]))*+"


def _term_and_count(term: Column, n: Column) -> Column:
    return F.struct(term.alias("term"), n.alias("n"))


def _rank_and_term(term: Column, n: Column) -> Column:
    return F.struct((-n).alias("rank"), term.alias("term"))


def with_term_counts(
    df: DataFrame, words: Column, out: str, shape: Callable[[Column, Column], Column] = _term_and_count
) -> DataFrame:
    """Add ``out``: array of (term, n), one entry per distinct word, by term.

    The count is made inside the row (sort the words, then cut the list where
    the word changes), so counting the words of a document needs no shuffle.
    A run of n equal words has n times the word's length plus n - 1 blanks,
    which gives n. The sorted list is a column of its own and is built once.
    """
    listed = f"__{out}_listed"
    df = df.withColumn(listed, F.array_join(F.sort_array(words), " "))

    def runs(group: int) -> Column:
        return F.regexp_extract_all(F.col(listed), F.lit(_RUN), F.lit(group))

    def entry(word: Column, run: Column) -> Column:
        times = F.call_function("div", F.length(run) + 1, F.length(word) + 1)
        return shape(word, times)

    return df.withColumn(out, F.zip_with(runs(1), runs(0), entry)).drop(listed)


def exploded_terms(df: DataFrame, counts: str, *keep: str) -> DataFrame:
    """One row (keep, term, n) per entry of a term-count array.

    The outer form is used because for the inner one the optimizer adds a
    non-empty filter and pushes it below the projections, which would count
    every text twice.
    """
    return df.select(*keep, F.inline_outer(counts)).filter(F.col("term").isNotNull())


def with_top_terms(df: DataFrame, words: Column, out: str, k: int) -> DataFrame:
    """Add ``out``: the ``k`` most frequent words, ties in word order."""
    counted = with_term_counts(df, words, out, _rank_and_term)
    best = F.slice(F.sort_array(F.col(out)), 1, k)
    return counted.withColumn(out, F.transform(best, lambda e: e["term"]))
