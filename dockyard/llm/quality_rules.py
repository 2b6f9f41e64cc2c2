r"""Quality rules: a threshold table compiled into one projection, without user functions.

Every measure of a text is a built-in expression, every rule a lower and an upper bound on one measure, and
`quality_rules` adds them all to the rows in place: no shuffle, no Python, one pass over the table.

Words are `[^\x20\x09-\x0D]+`, lines are split at \n. Defined cases: a null or empty text has no words, so it
fails `n_words`; a ratio over nothing is 0; equal rows get equal verdicts; further columns pass through.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockyard.llm.shared import SPACE, WORD, let, packed, unpacked

#: Frequent function words; a text in any of the four languages holds some of them.
STOP_WORDS = (
    "the be to of and a that have with in is it for as was on are by this from or an at "
    "der die das und in zu den von mit ist des sich dem ein eine nicht im auf als auch "
    "de la le et les des en un du une que est pour qui dans par pas au sur "
    "el los y se las por con para no su lo como más del"
).split()


@dataclass(frozen=True)
class Rule:
    """`measure` must lie in [low, high]; None leaves that side open."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None


BASE_RULES = (
    Rule("n_words", "n_words", low=50),
    Rule("repeated", "repeat_ratio", high=0.5),
)
RULES = (
    Rule("word_length", "mean_word_chars", low=2, high=12),
    Rule("symbols", "symbol_ratio", high=0.1),
    Rule("upper", "upper_ratio", high=0.5),
    Rule("dup_lines", "dup_line_ratio", high=0.3),
    Rule("stop_words", "n_stop_words", low=2),
    Rule("letter_words", "letter_word_ratio", low=0.7),
    Rule("ellipsis_lines", "ellipsis_line_ratio", high=0.3),
    Rule("bullet_lines", "bullet_line_ratio", high=0.9),
)
#: What `filtered` goes by: RULES, but duplicate lines count by their characters. Of few lines one short line said
#: twice is a large share of the count and next to nothing of the text.
FILTER_RULES = tuple(Rule(r.name, "dup_char_ratio", high=r.high) if r.name == "dup_lines" else r for r in RULES)
#: Each 3-word window of words joined by single spaces, in group 1; windows overlap, so they lie in a look-ahead.
GRAM = r"(?<![^ ])(?=([^ ]++ [^ ]++ [^ ]++))"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

MEASURES = (
    *COUNTS,
    "n_stop_words",
    "mean_word_chars",
    "symbol_ratio",
    "upper_ratio",
    "dup_line_ratio",
    "dup_char_ratio",
    "repeat_ratio",
    "letter_word_ratio",
    "ellipsis_line_ratio",
    "bullet_line_ratio",
)


def _repeat_words(grams: Column) -> Column:
    """Words covered by those 3-word windows that occur twice or more."""

    def covered(s: Column) -> Column:
        n = F.size(s)
        twin = lambda j: ((j > 0) & (s[F.greatest(j - 1, F.lit(0))]["g"] == s[j]["g"])) | (
            (j < n - 1) & (s[F.least(j + 1, n - 1)]["g"] == s[j]["g"])
        )
        at = F.transform(F.filter(F.sequence(F.lit(0), n - 1), twin), lambda j: s[j]["i"])
        return F.size(F.array_distinct(F.flatten(F.transform(at, lambda i: F.array(i, i + 1, i + 2)))))

    tagged = F.sort_array(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    some = F.size(F.array_distinct(grams)) < F.size(grams)
    return F.when(some, let(tagged, covered)).otherwise(0)


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(0.0)


def measured(docs: DataFrame) -> DataFrame:
    """`row` (all columns of `docs`) and one column `m`: a struct of the counts and ratios of its text."""
    text = F.coalesce(F.col("row.text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{SPACE}]"))
    split = packed(docs).select("row", F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("w"), lines.alias("l"))
    w, n, joined = F.col("w"), F.size("w"), F.array_join("w", " ")
    counted = split.select(
        "row",
        n.cast("long").alias("n_words"),
        (F.length(joined) - F.greatest(n - 1, F.lit(0))).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
        F.length(F.array_join("l", "")).alias("line_chars"),
        F.length(F.array_join(F.array_distinct("l"), "")).alias("own_line_chars"),
        F.regexp_extract_all(joined, F.lit(GRAM), F.lit(1)).alias("g"),
        F.size("l").cast("long").alias("n_lines"),
        F.regexp_count(text, F.lit(r"\p{Lu}")).alias("n_upper"),
        F.regexp_count(joined, F.lit(r"(?<![^ ])[^ \p{L}]++(?![^ ])")).alias("n_bare"),
        F.size(F.array_intersect(w, F.lit(list(STOP_WORDS)))).cast("long").alias("n_stop_words"),
        F.size(F.filter("l", lambda x: x.rlike(rf"(?:\.\.\.|…)[{SPACE}]*+\z"))).alias("n_ellipsis"),
        F.size(F.filter("l", lambda x: x.rlike(rf"^[{SPACE}]*[-*•]"))).alias("n_bullets"),
    )
    counted = counted.withColumn("n_repeat_words", _repeat_words(F.col("g")).cast("long")).drop("g")
    n = F.col("n_words")
    measures = F.struct(
        *COUNTS,
        "n_stop_words",
        _share(F.col("word_chars"), n).alias("mean_word_chars"),
        _share(F.col("n_symbols"), n).alias("symbol_ratio"),
        _share(F.col("n_upper"), F.col("word_chars")).alias("upper_ratio"),
        _share(F.col("n_dup_lines"), F.col("n_lines")).alias("dup_line_ratio"),
        _share(F.col("line_chars") - F.col("own_line_chars"), F.col("line_chars")).alias("dup_char_ratio"),
        _share(F.col("n_repeat_words"), n).alias("repeat_ratio"),
        _share(n - F.col("n_bare"), n).alias("letter_word_ratio"),
        _share(F.col("n_ellipsis"), F.col("n_lines")).alias("ellipsis_line_ratio"),
        _share(F.col("n_bullets"), F.col("n_lines")).alias("bullet_line_ratio"),
    )
    # A generator of one row: a filter on a verdict stays above it. Pushed below, it would measure the text once
    # more for every measure that it names.
    return counted.select("row", F.inline(F.array(measures))).select("row", F.struct(*MEASURES).alias("m"))


def fails(rule: Rule, m: str = "m") -> Column:
    value, out = F.col(f"{m}.{rule.measure}"), F.lit(False)
    if rule.low is not None:
        out = out | (value < rule.low)
    return out | (value > rule.high) if rule.high is not None else out


def quality_rules(docs: DataFrame, base: tuple[Rule, ...] = BASE_RULES, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """`row`, `m` (measures), `base_failed`, `failed` (names of all broken rules) and `kept`."""
    named = lambda r: F.when(fails(r), F.lit(r.name))
    judged = measured(docs).select(
        "row",
        "m",
        F.array_compact(F.array(*[named(r) for r in base])).alias("b"),
        F.array_compact(F.array(*[named(r) for r in rules])).alias("r"),
    )
    return judged.select(
        "row",
        "m",
        (F.size("b") > 0).alias("base_failed"),
        F.concat("b", "r").alias("failed"),
        ((F.size("b") == 0) & (F.size("r") == 0)).alias("kept"),
    )


def filtered(docs: DataFrame) -> DataFrame:
    """The documents that keep to BASE_RULES and FILTER_RULES, with the columns they came with."""
    return unpacked(quality_rules(docs, rules=FILTER_RULES).where("kept"), docs)


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, counts, `base_failed`, `kept` and the names of the broken rules."""
    return quality_rules(docs).select(
        F.col("row.doc_id").alias("doc_id"),
        *[F.col(f"m.{c}").alias(c) for c in COUNTS],
        "base_failed",
        "kept",
        F.array_join("failed", ",").alias("failed"),
    )
