"""Quality rules: a table of thresholds compiled into one projection, without user functions.

Text measures are array expressions over the words and lines of each row, so nothing is
shuffled and every row is judged alone.  Null text has no words.  Repeated rows, ties and
extra columns change nothing: each input row gives one output row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areaweave.llm.common import BLANK, pick, words_of

#: Frequent function words of English, French, German and Spanish.
STOP_WORDS = (
    "the of and to in a is that for it was on are as with be by this from at or an not "
    "de la le les et des en un une du que qui dans pour sur au par pas est plus "
    "der die und den von zu das mit sich des auf für ist im dem nicht ein eine als "
    "el los y del se las por con para una su al lo como"
).split()

#: As they stand in a text, at the start of a sentence or within one.
STOP_FORMS = [form for word in STOP_WORDS for form in (word, word.capitalize())]
#: Up to so many different repeated windows are looked up one by one.
FEW = 32


@dataclass(frozen=True)
class Rule:
    """A measure of the text and the range in which a document is kept; None leaves an end open."""

    name: str
    measure: str
    least: float | None = None
    most: float | None = None


#: What the measures of ``measure_text`` must satisfy.  Ratios are per word or per line.
RULES = (
    Rule("words", "n_words", least=50),
    Rule("word_length", "mean_word_chars", least=2, most=20),
    Rule("symbols", "symbols_per_word", most=0.1),
    Rule("stop_words", "stop_words_per_word", least=0.06),
    Rule("repeated_words", "repeats_per_word", most=0.5),
    Rule("repeated_lines", "dup_lines_per_line", most=0.5),
    Rule("bullet_lines", "bullets_per_line", most=0.9),
    Rule("ellipsis_lines", "ellipses_per_line", most=0.3),
)


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def measure_text(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                 carry: str | None = None) -> DataFrame:
    """Lengths, symbols, stop words, repeated words and line counts of every row; the column ``carry`` goes along."""
    text = F.coalesce(F.col("text"), F.lit(""))
    own = ["doc_id", *([carry] if carry else [])]
    base = pick(docs, doc_id=id_column, text=text_column, **({carry: carry} if carry else {})).select(
        *own, text.alias("text"), words_of(F.col("text")).alias("words"),
        F.filter(F.split(text, "\n"), lambda line: line.rlike(BLANK)).alias("lines"),
    )
    count, lines = F.size("words"), F.size("lines")
    base = base.select(
        *own, "words", "lines", F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
        (F.size(F.split("text", r"[#*$%&|<>]")) - 1).alias("n_symbols"),
    )
    base = base.withColumn("windows", F.slice(
        F.transform("hashes", lambda h, i: F.xxhash64(h, F.get("hashes", i + 1), F.get("hashes", i + 2))),
        F.lit(1), F.greatest(F.size("hashes") - 2, F.lit(0))))
    # Only rows in which some window repeats look for the places; a few repeated windows are
    # looked up, many are found by sorting the windows with their places.
    base = base.withColumn("ordered", F.when(
        F.size("windows") > F.size(F.array_distinct("windows")), F.sort_array("windows")))
    base = base.withColumn("twice", F.array_distinct(F.filter(
        "ordered", lambda x, k: F.coalesce(F.get("ordered", k - 1) == x, F.lit(False)))))
    base = base.withColumn("placed", F.when(F.size("twice") > FEW, F.sort_array(F.transform(
        "windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    alike = lambda other, x: F.coalesce(other["h"] == x["h"], F.lit(False))
    base = base.withColumn("starts", F.when(F.col("placed").isNotNull(), F.sort_array(F.transform(
        F.filter("placed", lambda x, k: alike(F.get("placed", k - 1), x) | alike(F.get("placed", k + 1), x)),
        lambda x: x["i"]))).when(F.col("twice").isNotNull(), F.filter(F.transform(
            "windows", lambda h, i: F.when(F.array_contains("twice", h), i)), lambda i: i.isNotNull())))
    covered = F.aggregate(
        F.zip_with("starts", F.slice("starts", F.lit(2), F.greatest(F.size("starts"), F.lit(1))),
                   lambda a, b: F.coalesce(F.least(b - a, F.lit(3)), F.lit(3))),
        F.lit(0).cast("bigint"), lambda total, x: total + x)
    return base.select(
        *own, count.cast("bigint").alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        F.col("n_symbols").cast("bigint").alias("n_symbols"),
        lines.cast("bigint").alias("n_lines"),
        (lines - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("bigint").alias("n_repeat_words"),
        F.size(F.filter("words", lambda w: w.isin(STOP_FORMS))).cast("bigint").alias("n_stop_words"),
        F.size(F.filter("lines", lambda x: x.rlike(r"^\s*[-*•‣]"))).cast("bigint").alias("n_bullet_lines"),
        F.size(F.filter("lines", lambda x: x.rlike(r"(\.\.\.|…)\s*$"))).cast("bigint").alias("n_ellipsis_lines"),
    )


def judge(measured: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Adds ``kept`` and ``failed`` (the names of the broken rules) to measured rows."""
    ratios = {
        "mean_word_chars": _ratio(F.col("word_chars"), F.col("n_words")),
        "symbols_per_word": _ratio(F.col("n_symbols"), F.col("n_words")),
        "stop_words_per_word": _ratio(F.col("n_stop_words"), F.col("n_words")),
        "repeats_per_word": _ratio(F.col("n_repeat_words"), F.col("n_words")),
        "dup_lines_per_line": _ratio(F.col("n_dup_lines"), F.col("n_lines")),
        "bullets_per_line": _ratio(F.col("n_bullet_lines"), F.col("n_lines")),
        "ellipses_per_line": _ratio(F.col("n_ellipsis_lines"), F.col("n_lines")),
    }
    broken = []
    for rule in rules:
        value = ratios.get(rule.measure, F.col(rule.measure))
        low = value < rule.least if rule.least is not None else F.lit(False)
        high = value > rule.most if rule.most is not None else F.lit(False)
        broken.append(F.when(low | high, F.lit(rule.name)))
    failed = F.array_compact(F.array(*broken))
    return measured.withColumn("failed", failed).withColumn("kept", F.size("failed") == 0)


def quality_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_column: str = "doc_id",
                  text_column: str = "text") -> DataFrame:
    """Measures, verdict and broken rules of every row of ``docs``."""
    return judge(measure_text(docs, id_column, text_column), rules)


def accepted(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that satisfy every rule, with all their columns."""
    row = docs.select(F.struct(*[docs[f"`{c}`"].alias(c) for c in docs.columns]).alias("whole_row"))
    row = row.select("whole_row", F.lit(0).alias("doc_id"), F.col(f"whole_row.`{text_column}`").alias("text"))
    # The row number keeps the optimizer from writing all measures into the filter, once for each use.
    judged = judge(measure_text(row, carry="whole_row"), rules).withColumn("at", F.monotonically_increasing_id())
    return judged.where(F.col("kept") & (F.col("at") >= 0)).select("whole_row.*")
