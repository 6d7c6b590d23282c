"""Language identification by frequent words, with letter trigrams as tie-break.

A profile holds, per language, its most frequent words and the most frequent
trigrams of those words' letters. A text gets the language whose word profile
covers most of its words; only where no word is known, or two languages tie,
are its trigrams looked at. Both tests are made inside the row against
constant hash sets, so a text is neither exploded nor shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dockhand.functions.text import strip, tokens, trigrams

PROFILE_SIZE = 300  # entries per language and kind, the usual size of a rank-order profile
MAX_LANGUAGES = 200  # bounds the profile that is read to the driver
MIN_LENGTH = 10  # texts up to this length get no language
UNDECIDED = "und"
WORD, GRAM = "word", "gram"


@dataclass(frozen=True)
class Profile:
    """Per language: its frequent words and its frequent trigrams."""

    words: dict[str, list[str]]
    grams: dict[str, list[str]]


def _padded(text: Column) -> Column:
    return F.concat(F.lit(" "), text, F.lit(" "))


def profile_table(
    labelled: DataFrame, text: str, lang: str, groups: list[str] | None = None, size: int = PROFILE_SIZE
) -> DataFrame:
    """Rows (groups, lang, kind, entry, rank): the ``size`` most frequent entries of each kind.

    The texts are read once, to count words; words combine on the map side, so
    a common word or a dominant language is one row per task in the shuffle.
    Trigrams are counted over the distinct words, weighted by their counts.
    """
    keys = [*(groups or []), lang]
    words = (
        labelled.select(*keys, F.explode(tokens(F.col(text))).alias("word"))
        .groupBy(*keys, "word")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    as_words = words.select(*keys, "n", F.lit(WORD).alias("kind"), F.col("word").alias("entry"))
    as_grams = words.select(*keys, "n", F.lit(GRAM).alias("kind"), F.explode(trigrams(_padded(F.col("word")))).alias("entry"))
    entries = as_words.unionByName(as_grams)  # both read the same exchange
    counted = entries.groupBy(*keys, "kind", "entry").agg(F.sum("n").alias("n"))
    best = Window.partitionBy(*keys, "kind").orderBy(F.desc("n"), "entry")
    return counted.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= size)


def _profile_of(rows: list, size: int) -> Profile:
    found: dict[str, dict[str, list[str]]] = {WORD: {}, GRAM: {}}
    for language, kind, entry in rows:
        found[kind].setdefault(language, []).append(entry)
    if len(found[WORD]) > MAX_LANGUAGES:
        raise ValueError(f"language profile of more than {MAX_LANGUAGES} languages")
    return Profile(
        *({language: sorted(entries) for language, entries in sorted(found[kind].items())} for kind in (WORD, GRAM))
    )


def load_profiles(profile: DataFrame, group: Column, lang: str = "lang", size: int = PROFILE_SIZE) -> dict:
    """Read a profile table to the driver, one profile per value of ``group``. Runs a job.

    By construction there are at most ``size`` rows per language and kind; the
    read is bounded and more languages than ``MAX_LANGUAGES`` are refused.
    """
    limit = 4 * size * MAX_LANGUAGES
    rows = profile.select(group.alias("group"), lang, "kind", "entry").limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"language profile has more than {limit} rows")
    grouped: dict = {}
    for value, *row in rows:
        grouped.setdefault(value, []).append(row)
    return {value: _profile_of(members, size) for value, members in grouped.items()}


def train_profile(labelled: DataFrame, text: str = "text", lang: str = "lang") -> Profile:
    """Profile from labelled texts. Runs a job over the labelled table."""
    learned = load_profiles(profile_table(labelled, text, lang), F.lit(0), lang)
    return learned.get(0, Profile({}, {}))


def _quoted(entry: str) -> str:
    return "'" + entry.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _ranking(items: str, known: dict[str, list[str]]) -> str:
    """SQL for the array of (minus hits, language), best first.

    Written as SQL text: a profile has thousands of constants, and a text is
    handed over in one piece instead of one call per constant.
    """
    scores = [
        f"struct(-size(filter({items}, item -> item IN ({', '.join(map(_quoted, entries))}))) AS rank, "
        f"{_quoted(language)} AS language)"
        for language, entries in known.items()
    ]
    return f"sort_array(array({', '.join(scores)}))"


def best_language(words: str, profile: Profile) -> Column:
    """Language of a text given the column of its words; NULL words give NULL."""
    if not profile.words:
        return F.when(F.col(words).isNotNull(), UNDECIDED)
    # one-element arrays bind the trigrams and the rankings to names, so each is computed once
    by_word = F.expr(
        f"get(transform(array({_ranking(words, profile.words)}), r -> CASE WHEN r[0].rank < 0 "
        "AND (size(r) = 1 OR r[0].rank < get(r, 1).rank) THEN r[0].language END), 0)"
    )
    grams = "regexp_extract_all(concat(' ', array_join({}, ' '), ' '), '(?s)(?=(...))', 1)".format(words)
    by_gram = F.expr(
        f"get(transform(transform(array({grams}), g -> {_ranking('g', profile.grams)}), "
        f"r -> CASE WHEN r[0].rank < 0 THEN r[0].language ELSE '{UNDECIDED}' END), 0)"
    )
    return F.when(F.col(words).isNotNull(), F.coalesce(by_word, by_gram))


def is_long_enough(text: Column) -> Column:
    """Language gate: more than ``MIN_LENGTH`` characters besides outer white space."""
    return F.length(strip(text)) > MIN_LENGTH


def detect_language(df: DataFrame, profile: Profile, text: str = "text", out: str = "language") -> DataFrame:
    """Add the language; NULL for short texts, ``und`` when nothing matches."""
    words = f"__{out}_words"
    return (
        df.withColumn(words, F.when(is_long_enough(F.col(text)), tokens(F.col(text))))
        .withColumn(out, best_language(words, profile))
        .drop(words)
    )


def fold_of(text: Column) -> Column:
    """Fold 0 or 1 by content hash, so exact copies never straddle the folds."""
    return F.when(F.substring(F.md5(text), 1, 1) < "8", 0).otherwise(1)


def cross_validated_accuracy(labelled: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """Per language: texts, and texts recognised by a profile of the other fold.

    Both folds are scored, so every text counts once. Runs one job per call
    to learn the two profiles.
    """
    folded = labelled.select(F.col(text), F.col(lang), fold_of(F.col(text)).alias("fold"))
    learned = load_profiles(profile_table(folded, text, lang, ["fold"]), F.col("fold"), lang)
    nothing = Profile({}, {})
    scored = folded.withColumn("words", tokens(F.col(text))).withColumn(
        "language",
        F.when(F.col("fold") == 0, best_language("words", learned.get(1, nothing))).otherwise(
            best_language("words", learned.get(0, nothing))
        ),
    )
    return scored.groupBy(lang).agg(
        F.count(F.lit(1)).alias("n_texts"),
        F.count_if(F.col("language") == F.col(lang)).alias("n_right"),
    )
