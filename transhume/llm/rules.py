"""Quality rules: a table of thresholds compiled into one projection of built-in functions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transhume.llm.text import words_of

#: Words of a window of which repeats are counted.
WINDOW = 8

#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "a an and are as at be by for from in is it of on or that the this to was with "
    "als auf das dem den der des die ein eine für im in ist mit nicht sich und von zu "
    "au avec dans de des du elle en est et la le les par pas pour que qui sur un une "
    "al con de del el en es las lo los no para por que se su una y"
).split()


@dataclass(frozen=True)
class Rule:
    """``low <= measure <= high``; a bound of None holds always."""

    measure: str
    low: float | None = None
    high: float | None = None

    def holds(self) -> Column:
        value = F.col(self.measure)
        out = F.lit(True)
        if self.low is not None:
            out &= value >= self.low
        if self.high is not None:
            out &= value <= self.high
        return out


#: The production table. Measures are columns of ``measured``.
TABLE = (
    Rule("n_words", 20, None),
    Rule("repeat_share", None, 0.3),
    Rule("word_length", 2, 12),
    Rule("symbol_share", None, 0.1),
    Rule("upper_share", None, 0.5),
    Rule("stop_share", 0.03, None),
    Rule("dup_line_share", None, 0.5),
    Rule("bullet_share", None, 0.9),
    Rule("open_line_share", None, 0.9),
)


def _length_without(text: Column, characters: str) -> Column:
    return F.char_length(text) - F.char_length(F.translate(text, characters, ""))


def measured(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Counts and shares of every whole text, beside the input in the struct ``_row``.

    Null counts as the empty text; shares of nothing are 0. All steps are projections of
    built-in functions: no shuffle, no user function. Windows are compared by a 64-bit hash
    of their words.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(row, text.alias("_t"), words_of(F.col(text_col)).alias("_w"))
    white = " \t\n\x0b\x0c\r"
    lines = F.filter(F.split("_t", "\n"), lambda line: F.char_length(F.translate(line, white, "")) > 0)
    n = F.size("_w")
    windows = F.when(
        n >= WINDOW, F.transform(F.sequence(F.lit(1), n - (WINDOW - 1)), lambda i: F.xxhash64(F.slice("_w", i, WINDOW)))
    )
    step = base.select("_row", "_t", "_w", lines.alias("_lines"), windows.alias("_h"))
    again = F.size(F.array_distinct("_h")) < F.size("_h")
    placed = F.array_sort(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    step = step.select("_row", "_t", "_w", "_lines", F.when(again, placed).alias("_p"))
    twice = F.filter(
        "_p",
        lambda p, k: F.coalesce(p["h"] == F.get("_p", k - 1)["h"], F.lit(False))
        | F.coalesce(p["h"] == F.get("_p", k + 1)["h"], F.lit(False)),
    )
    starts = F.array_sort(F.transform(twice, lambda p: p["i"]))
    covered = F.aggregate(
        starts,
        F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n")),
        lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(WINDOW), i - a["last"])).alias("n")),
        lambda a: a["n"],
    )
    n_lines = F.size("_lines")
    step = step.select(
        "_row",
        n.cast("long").alias("n_words"),
        F.char_length(F.translate("_t", white, "")).cast("long").alias("word_chars"),
        _length_without(F.col("_t"), "#*$%&|<>").cast("long").alias("n_symbols"),
        (n_lines - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        n_lines.cast("long").alias("n_lines"),
        F.size(F.filter("_w", lambda w: F.lower(w).isin(*sorted(set(STOP_WORDS))))).alias("_stops"),
        F.size(F.filter("_lines", lambda s: s.rlike(r"^\s*[-*•]\s"))).alias("_bullets"),
        F.size(F.filter("_lines", lambda s: s.rlike(r"(\.\.\.|…)\s*$"))).alias("_open"),
        _length_without(F.col("_t"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ").alias("_upper"),
    )
    share = lambda a, b: F.coalesce(a / F.nullif(F.col(b), F.lit(0)), F.lit(0.0))
    return step.select(
        "*",
        share(F.col("n_repeat_words"), "n_words").alias("repeat_share"),
        share(F.col("word_chars"), "n_words").alias("word_length"),
        share(F.col("n_symbols"), "word_chars").alias("symbol_share"),
        share(F.col("_upper"), "word_chars").alias("upper_share"),
        share(F.col("_stops"), "n_words").alias("stop_share"),
        share(F.col("n_dup_lines"), "n_lines").alias("dup_line_share"),
        share(F.col("_bullets"), "n_lines").alias("bullet_share"),
        share(F.col("_open"), "n_lines").alias("open_line_share"),
    )


def verdict(rules: tuple[Rule, ...] = TABLE) -> Column:
    """Whether all rules hold."""
    out = F.lit(True)
    for rule in rules:
        out &= rule.holds()
    return out


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def keep_good(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = TABLE) -> DataFrame:
    """Rows whose text satisfies every rule; all columns stay. Null and empty texts have no words and go."""
    return measured(docs, text_col).where(verdict(rules)).select("_row.*")
