"""Quality rules: a threshold table compiled into one projection of built-in functions."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farebox.llm.common import WORD_GAP, let, whole_text, words

# Frequent words of English, Spanish, French, German, Italian, Portuguese, Dutch, Swedish, Danish
# and Norwegian, Finnish, and Indonesian: languages written with the letters of ASCII and Latin-1.
STOP_WORDS = (
    "the of and to in is that for it with as on by be this are from at or an a was not "
    "de la que el en y los del se las por un para con no su al lo como "
    "le les et des du une est dans pour sur au qui ne pas ce "
    "der die das und zu den von ist mit sich auf nicht ein eine im dem "
    "il di che non per gli della sono "
    "os uma não com mais dos em foi "
    "het een van niet voor zijn met dat "
    "och att det som på är för inte "
    "og at er til ikke af av jeg "
    "ja on ei että oli mutta kun hän "
    "yang dan di itu dengan untuk tidak ini"
).split()
#: Letters that none of these languages uses. A text with more than ``FOREIGN`` of them per character is in a
#: language the list does not reach, and the stop-word rule says nothing about it.
FOREIGN_LETTER = r"[\x{100}-\x{151}\x{154}-\x{1FFF}\x{2C00}-\x{2DFF}\x{3005}-\x{10FFFF}]"
FOREIGN = 0.01


class Rule(NamedTuple):
    """A statistic of the text must lie between ``low`` and ``high``; None leaves that side open."""

    statistic: str
    low: float | None = None
    high: float | None = None


RULES = (
    Rule("mean_word_chars", 2, 20),
    Rule("symbols_per_word", None, 0.2),
    Rule("shouts_per_word", None, 0.4),
    Rule("alphabetic_share", 0.5, None),
    Rule("stop_word_share", 0.02, None),
    Rule("dup_line_share", None, 0.5),
    Rule("bullet_line_share", None, 0.9),
    Rule("ellipsis_line_share", None, 0.4),
)


def _repeated_words(w: Column) -> Column:
    """Words inside a three-word window that the text holds twice or more.

    Windows are told apart by a 64-bit hash; texts whose hashes all differ stop there.
    """
    empty = F.array().cast("array<bigint>")
    hashes = F.when(
        F.size(w) >= 3,
        F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(w[i], w[i + 1], w[i + 2])),
    ).otherwise(empty)

    def covered(h: Column) -> Column:
        placed = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def twins(s: Column) -> Column:
            twin = F.filter(s, lambda x, j: (x["h"] == F.get(s, j - 1)["h"]) | (x["h"] == F.get(s, j + 1)["h"]))
            spread = F.transform(twin, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2))
            return F.size(F.array_distinct(F.flatten(spread)))

        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(placed, twins))

    return let(hashes, covered)


def statistics(text: Column) -> Column:
    """Struct of counts over the whole text."""
    lines = F.filter(F.split(text, "\n"), lambda line: F.regexp_replace(line, WORD_GAP, "") != "")

    def of_words(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            _repeated_words(w).cast("long").alias("n_repeat_words"),
            F.size(F.filter(w, lambda x: F.lower(x).isin(STOP_WORDS))).alias("stop_words"),
        )

    def of_lines(a: Column) -> Column:
        return F.struct(
            F.size(a).alias("n_lines"),
            (F.size(a) - F.size(F.array_distinct(a))).cast("long").alias("n_dup_lines"),
            F.size(F.filter(a, lambda x: x.rlike(r"^[\x20\x09-\x0D]*[-*•]"))).alias("bullets"),
            F.size(F.filter(a, lambda x: x.rlike(r"(\.\.\.|…)[\x20\x09-\x0D]*$"))).alias("ellipses"),
        )

    return F.struct(
        let(words(text), of_words).alias("w"),
        let(lines, of_lines).alias("l"),
        (F.length(text) - F.regexp_count(text, F.lit(r"[\x20\x09-\x0D]"))).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_count(text, F.lit(r"!!")).alias("shouts"),
        F.regexp_count(text, F.lit(FOREIGN_LETTER)).alias("foreign"),
        F.regexp_count(text, F.lit(r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9A-Za-z\x80-\x{10FFFF}]*+[A-Za-z\x80-\x{10FFFF}]")).alias("alphabetic"),
    )


def ratios(s: Column) -> dict[str, Column]:
    """What the table's thresholds speak of, from ``statistics``."""
    n = F.greatest(s["w"]["n_words"], F.lit(1))
    lines = F.greatest(s["l"]["n_lines"], F.lit(1))
    return {
        "mean_word_chars": s["word_chars"] / n,
        "symbols_per_word": s["n_symbols"] / n,
        "shouts_per_word": s["shouts"] / n,
        "alphabetic_share": s["alphabetic"] / n,
        "stop_word_share": F.when(s["foreign"] > FOREIGN * s["word_chars"], 1.0).otherwise(s["w"]["stop_words"] / n),
        "dup_line_share": s["l"]["n_dup_lines"] / lines,
        "bullet_line_share": s["l"]["bullets"] / lines,
        "ellipsis_line_share": s["l"]["ellipses"] / lines,
    }


def verdict(s: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """True where every rule of the table holds."""
    values = ratios(s)
    held = F.lit(True)
    for rule in rules:
        value = values[rule.statistic]
        if rule.low is not None:
            held = held & (value >= rule.low)
        if rule.high is not None:
            held = held & (value <= rule.high)
    return held


def base_failed(s: Column) -> Column:
    return (s["w"]["n_words"] < 50) | (100 * s["w"]["n_repeat_words"] > 50 * s["w"]["n_words"])


def judged(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Statistics and verdict per row of ``docs``, in one projection and without a shuffle.

    A null text has no words and fails; repeated rows are judged alike; other columns are not read.
    """
    s = F.col("s")
    return docs.select(docs["doc_id"], statistics(whole_text(docs)).alias("s")).select(
        "doc_id",
        s["w"]["n_words"].alias("n_words"),
        s["word_chars"].alias("word_chars"),
        s["n_symbols"].alias("n_symbols"),
        s["l"]["n_dup_lines"].alias("n_dup_lines"),
        s["w"]["n_repeat_words"].alias("n_repeat_words"),
        base_failed(s).alias("base_failed"),
        (~base_failed(s) & verdict(s, rules)).alias("kept"),
    )


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs`` that pass, all columns as they came."""
    return docs.where(let(statistics(whole_text(docs)), lambda s: ~base_failed(s) & verdict(s, rules)))
