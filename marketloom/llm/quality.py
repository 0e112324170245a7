"""Cleaning line by line: lines that break a rule go, and texts that lose too much with them.

Everything is column expressions over one row; there is no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import ascii_words, blank_free, whole_row, with_results

WORD = r"[^\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"

# What the line rules look for.
SENTENCE_MARK = r"[.!?:;]"
SYMBOL_RUN = r"[#*$%&<>]{2,}"
SHOUT_RUN = r"[!?]{2,}"
SEPARATOR = r"[|»›•·]"
BOILERPLATE = (
    "accept all cookies",
    "all rights reserved",
    "back to top",
    "click here",
    "cookie policy",
    "enable javascript",
    "follow us on",
    "lorem ipsum",
    "privacy policy",
    "sign up for our newsletter",
    "skip to content",
    "terms of service",
    "terms of use",
)

#: A line without a sentence mark may have so many words.
UNMARKED_WORDS = 10
#: One match for so many words makes a line symbols, shouting or a menu.
WORDS_PER_MARK = 5
#: A text may lose this many of a hundred words.
LOSS_PERCENT = 30
MIN_WORDS = 50
REPEAT_PERCENT = 50


def judge_lines(
    df: DataFrame,
    text: str = "text",
    loss_percent: int = LOSS_PERCENT,
    carry: list[str] | None = None,
) -> DataFrame:
    """Every row of ``df`` with word figures, ``base_failed``, ``clean_text``, ``lost_words`` and ``kept``.

    A line fails by punctuation (``UNMARKED_WORDS`` words or more without a
    sentence mark, or runs of symbols or of exclamation marks in one of
    ``WORDS_PER_MARK`` words), as navigation (as many separators, two at least) or
    as boilerplate (listed phrases, in any case, whose words are one in as many, so
    that a long line may mention one). ``clean_text`` is the rest, in order. A text is kept unless it fails on the whole (under ``MIN_WORDS`` words,
    or over ``REPEAT_PERCENT`` of a hundred in repeated three-word windows) or
    loses more than ``loss_percent`` of a hundred words with its lines.

    NULL has no words, so it fails, and its ``clean_text`` is NULL; so does an
    empty text. ``carry`` names the input columns to return (all by default); a
    result replaces an input column of its name. Repeated rows are judged alike;
    an empty table gives no rows.
    """
    names = df.columns if carry is None else carry
    rows = _pin(
        df.select(whole_row(df, names).alias("row"), F.col(text).alias("text")),
        words=ascii_words(F.col("text")),
        lines=F.split(F.coalesce("text", F.lit("")), "\n"),
    )
    rows = _pin(
        rows,
        windows=_when_windows(
            F.transform(_window_numbers(), lambda i: F.xxhash64(_word(i), _word(i + 1), _word(i + 2)))
        ),
        spoken=F.filter("lines", lambda line: line.rlike(WORD)),
        judged=F.transform("lines", lambda line: F.struct(line.alias("line"), _line_fails(line).alias("fails"))),
    )
    # Equal windows have equal hashes; only texts with equal hashes need the sort, which compares the words.
    rows = _pin(
        rows,
        sorted=F.when(
            F.size(F.array_distinct("windows")) < F.size("windows"),
            F.sort_array(
                F.transform(
                    _window_numbers(),
                    lambda i: F.struct(F.concat_ws(" ", _word(i), _word(i + 1), _word(i + 2)).alias("w"), i.alias("i")),
                )
            ),
        ),
        n_words=F.size("words").cast("long"),
        lost_words=F.aggregate(
            F.filter("judged", lambda x: x["fails"]),
            F.lit(0).cast("long"),
            lambda total, x: total + F.regexp_count(x["line"], F.lit(WORD)),
        ),
    )
    rows = _pin(rows, n_repeat_words=_repeat_words())
    base_failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words")
    )
    results = {
        "n_words": F.col("n_words"),
        "word_chars": F.length(blank_free(F.col("text"))).cast("long"),
        "n_symbols": F.coalesce(F.regexp_count("text", F.lit(SYMBOL)), F.lit(0)).cast("long"),
        "n_dup_lines": (F.size("spoken") - F.size(F.array_distinct("spoken"))).cast("long"),
        "n_repeat_words": F.col("n_repeat_words"),
        "base_failed": base_failed,
        "lost_words": F.col("lost_words"),
        "kept": ~base_failed & (100 * F.col("lost_words") <= loss_percent * F.col("n_words")),
    }
    if carry is None:
        left = F.transform(F.filter("judged", lambda x: ~x["fails"]), lambda x: x["line"])
        clean = F.when(F.exists("judged", lambda x: x["fails"]), F.array_join(left, "\n")).otherwise(F.col("text"))
        results["clean_text"] = clean
    return with_results(rows, names, results)


def _pin(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns behind a one-element generator, so that they are computed once and not merged into their uses."""
    pinned = F.explode(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))).alias("pin")
    return df.select("*", pinned).select(*df.columns, "pin.*")


def _word(place: Column) -> Column:
    return F.get("words", place)


def _window_numbers() -> Column:
    return F.sequence(F.lit(0), F.size("words") - 3)


def _when_windows(value: Column) -> Column:
    return F.when(F.size("words") >= 3, value)


def _repeat_words() -> Column:
    """Words in windows that have an equal one, each counted once."""

    def has_equal(window: Column, place: Column) -> Column:
        equal = [F.coalesce(F.get("sorted", place + step)["w"] == window["w"], F.lit(False)) for step in (-1, 1)]
        return equal[0] | equal[1]

    places = F.transform(F.filter("sorted", has_equal), lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2))
    return F.coalesce(F.size(F.array_distinct(F.flatten(places))), F.lit(0)).cast("long")


def _line_fails(line: Column) -> Column:
    words = F.regexp_count(line, F.lit(WORD))
    separators = F.regexp_count(line, F.lit(SEPARATOR))
    phrases = "|".join(BOILERPLATE)
    held = F.array_join(F.regexp_extract_all(F.lower(line), F.lit(phrases), F.lit(0)), " ")
    return (
        (~line.rlike(SENTENCE_MARK) & (words >= UNMARKED_WORDS))
        | (line.rlike(SYMBOL_RUN) & (WORDS_PER_MARK * F.regexp_count(line, F.lit(SYMBOL_RUN)) >= words))
        | (line.rlike(SHOUT_RUN) & (WORDS_PER_MARK * F.regexp_count(line, F.lit(SHOUT_RUN)) >= words))
        | (line.rlike(SEPARATOR) & (separators >= 2) & (WORDS_PER_MARK * separators >= words))
        | (F.lower(line).rlike(phrases) & (WORDS_PER_MARK * F.regexp_count(held, F.lit(WORD)) >= words))
    )
