"""Splitting lines and counting words."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

POISON = "bug"


def words_on_whitespace(lines: DataFrame, line: str = "line", word: str = "word", keep: tuple[str, ...] = ()) -> DataFrame:
    return lines.select(*keep, F.explode(F.split(F.col(line), r"\s")).alias(word))


def words_on_space(lines: DataFrame, line: str = "line", word: str = "word", keep: tuple[str, ...] = ()) -> DataFrame:
    """Split at single blanks. Empty words stay, except at the end of a line.

    A line of blanks only has no words; an empty line has one, the empty one.
    """
    trimmed = F.rtrim(F.col(line))
    blanks_only = (F.col(line) != "") & (trimmed == "")
    pieces = F.when(blanks_only, F.array().cast("array<string>")).otherwise(F.split(trimmed, " "))
    return lines.select(*keep, F.explode(pieces).alias(word))


def non_empty(words: DataFrame, word: str = "word") -> DataFrame:
    return words.where(F.col(word) != "")


def fail_on(words: DataFrame, poison: str = POISON, word: str = "word") -> DataFrame:
    """Let the job fail at a poisoned word."""
    guarded = F.when(F.col(word) == poison, F.raise_error(F.lit(f"{poison}....."))).otherwise(F.col(word))
    return words.withColumn(word, guarded)


def with_one(words: DataFrame, word: str = "word") -> DataFrame:
    return words.select(word, F.lit(1).alias("n"))


def count_words(words: DataFrame, word: str = "word") -> DataFrame:
    """Counts per word. On a stream in update mode: the counts that changed, per batch."""
    return words.groupBy(word).agg(F.count("*").alias("n"))


def sum_pairs(pairs: DataFrame, word: str = "word", n: str = "n") -> DataFrame:
    return pairs.groupBy(word).agg(F.sum(n).alias(n))


def count_words_in_windows(words: DataFrame, ts: str, size: str = "5 seconds", word: str = "word") -> DataFrame:
    return words.groupBy(F.window(F.col(ts), size).alias("win"), word).agg(F.count("*").alias("n"))


def labelled_counts(counts: DataFrame, word: str = "word", n: str = "n") -> DataFrame:
    """``word::n`` lines."""
    return counts.select(F.concat(F.col(word), F.lit("::"), F.col(n).cast("string")).alias("value"))
