"""Line-first cleaning of texts, with DataFrame functions alone.

Rules are evaluated for each line; lines that fail are removed, and documents that lose too much of their text, or fail
the base rules on their whole text, are rejected.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rules:
    """Limits of the rules; shares are in percent."""

    min_words: int = 10
    max_repeated: int = 20  # of a text's words, in windows found twice or more
    window: int = 5
    max_symbols: int = 10  # of a line's characters
    max_marks: int = 8  # exclamation and question marks, of a line's characters
    max_bars: int = 1  # bars between links of a navigation line
    max_lost: int = 50  # of a text's word characters
    boilerplate: tuple[str, ...] = (
        "all rights reserved",
        "licensed under",
        "terms of (use|service)",
        "privacy policy",
        "(accept|use) cookies",
        "copyright \\d{4}",
        "enable javascript",
        "sign in to continue",
        "subscribe to our newsletter",
        "lorem ipsum",
    )


def _characters(text: Column, listed: str) -> Column:
    return F.length(text) - F.length(F.translate(text, listed, ""))


def _without_blanks(text: Column) -> Column:
    return F.translate(text, " \t\n\x0b\x0c\r", "")


def line_passes(line: Column, rules: Rules) -> Column:
    """Whether a line stays. A line without words stays; it takes no part in any share.

    Punctuation: the line ends a sentence, and exclamation and question marks are few. Navigation: at most
    ``max_bars`` bars, and few symbols. Boilerplate: none of the phrases.
    """
    size = F.length(line)
    sentence = line.rlike(r"[.!?…:;。！？][\"'”’»)\]]*[\x20\x09-\x0D]*$") & (100 * _characters(line, "!?") <= rules.max_marks * size)
    links = (_characters(line, "|") <= rules.max_bars) & (100 * _characters(line, SYMBOLS) <= rules.max_symbols * size)
    phrases = ~line.rlike(rf"(?i)\b(?:{'|'.join(rules.boilerplate)})") if rules.boilerplate else F.lit(True)
    return ~line.rlike(WORD) | (sentence & links & phrases)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once for each row, wherever the optimizer puts the expression."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _repeated_words(words: Column, width: int) -> Column:
    """Words inside windows whose hash is found twice or more in the text."""

    def windows(own: Column) -> Column:
        last = F.size(own) - width
        one = lambda i: F.xxhash64(*[F.get(own, i + k) for k in range(width)])
        return F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), one)).otherwise(F.array().cast("array<bigint>"))

    def found_twice(pairs: Column) -> Column:
        """Rising places of windows next to one of the same hash."""

        def same(pair: Column, j: Column) -> Column:
            before, after = F.get(pairs, j - 1)["h"], F.get(pairs, j + 1)["h"]
            return F.coalesce(pair["h"] == before, F.lit(False)) | F.coalesce(pair["h"] == after, F.lit(False))

        return F.sort_array(F.transform(F.filter(pairs, same), lambda p: p["i"]))

    def covered(places: Column) -> Column:
        gaps = F.transform(places, lambda p, j: F.least(F.lit(width), F.coalesce(F.get(places, j + 1) - p, F.lit(width))))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda total, gap: total + gap)

    def counted(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        some = _let(pairs, lambda p: _let(found_twice(p), covered))
        return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), some).otherwise(F.lit(0).cast("long"))

    return _let(words, lambda own: _let(windows(own), counted))


def judged(docs: DataFrame, rules: Rules = Rules(), text_col: str = "text") -> DataFrame:
    """``docs`` with the text's counts, what is left of it, and the verdict.

    Adds ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` (longs), ``base_failed, kept`` (booleans) and
    ``clean_text``; columns of these names are replaced. A null text has no words, fails the base rules and stays null;
    so does an empty one. Rows are judged one by one: repeated rows get the same verdict, an empty table gives none.
    Windows are compared by 64-bit hashes. All work for a text is linear in its words but for sorting.
    """
    text = F.coalesce(docs[text_col], F.lit(""))
    out = docs.drop("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "clean_text")
    counts = F.struct(
        F.size("_q_words").cast("long").alias("n_words"),
        F.length(_without_blanks(text)).cast("long").alias("word_chars"),
        _characters(text, SYMBOLS).cast("long").alias("n_symbols"),
        (F.size("_q_full") - F.size(F.array_distinct("_q_full"))).cast("long").alias("n_dup_lines"),
    )
    steps = (
        out.withColumn("_q_words", F.regexp_extract_all(text, F.lit(WORD), 0))
        .withColumn("_q_lines", F.split(text, "\n"))
        .withColumn("_q_full", F.filter("_q_lines", lambda line: line.rlike(WORD)))
        .withColumn("_q_counts", counts)
        .withColumn("_q_left", F.array_join(F.filter("_q_lines", lambda line: line_passes(line, rules)), "\n"))
        .withColumn("n_repeat_words", _repeated_words(F.col("_q_words"), rules.window))
        .select("*", "_q_counts.*")
    )
    failed = (F.col("n_words") < rules.min_words) | (100 * F.col("n_repeat_words") > rules.max_repeated * F.col("n_words"))
    left = F.length(_without_blanks(F.col("_q_left")))
    enough = 100 * left >= (100 - rules.max_lost) * F.col("word_chars")
    return (
        steps.withColumn("base_failed", failed)
        .withColumn("kept", ~failed & enough & (left > 0))
        .withColumn("clean_text", F.when(docs[text_col].isNotNull(), F.col("_q_left")))
        .drop(*[f"_q_{name}" for name in ("words", "lines", "full", "counts", "left")])
    )
