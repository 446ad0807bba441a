"""Quality rules: a threshold table compiled into one projection. Native, no shuffle.

Every figure of a document is a Column expression over its own row, so the operator is a map:
one scan, no exchange, memory bounded by one row. A rule is a row of :data:`RULES`; the table is
compiled into one boolean expression and, for reporting, one array of failed rule names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ripplebook.llm.common import SPACES, words_of

#: Function words of the corpus languages (en, fr, de, es); matched on whole words, plain or capitalised.
STOP_WORDS = (
    "the and of to in is that it for was on with as be by this are from or an at have not but "
    "le la les de des du et un une en dans que qui pour par sur est au avec il pas "
    "der die das und ist nicht von zu mit den dem ein eine auf im sich auch für als "
    "el los las y a del se con una su al lo como más o pero por es no"
).split()


@dataclass(frozen=True)
class Rule:
    """Passes while ``low <= metric <= high``; a null bound is open. Ratios of empty texts are 0."""

    name: str
    metric: str
    low: float | None = None
    high: float | None = None


#: Length, symbol, stop-word and line rules. Bounds are loose: they are for junk, not for style.
RULES = (
    Rule("word_count", "n_words", low=50),
    Rule("repeated_words", "repeat_ratio", high=0.5),
    Rule("mean_word_length", "mean_word_chars", low=2.0, high=14.0),
    Rule("symbols_per_word", "symbol_ratio", high=0.25),
    Rule("stop_words_share", "stop_ratio", low=0.04),
    Rule("duplicate_lines", "dup_line_ratio", high=0.5),
    Rule("exclamations_per_word", "shout_ratio", high=0.5),
)


def _window_hashes(words: Column, n: Column) -> Column:
    """A 64-bit hash of each 3-word window, in order."""
    at = F.when(n >= 3, F.sequence(F.lit(0), n - 3)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))


def _positions_by_hash(hashes: Column) -> Column:
    """(hash, position) sorted by hash; nothing where no hash repeats, which most texts end with."""
    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
    none = F.array().cast("array<struct<h:bigint,p:int>>")
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), pairs).otherwise(none)


def _repeated(pairs: Column) -> Column:
    """Positions of the windows that occur twice or more, from the sorted pairs."""
    near = lambda x, i: (F.get(pairs, i - 1)["h"] == x["h"]) | (F.get(pairs, i + 1)["h"] == x["h"])
    return F.transform(F.filter(pairs, lambda x, i: F.coalesce(near(x, i), F.lit(False))), lambda x: x["p"])


def with_metrics(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds one struct column ``quality`` of figures. Null and empty texts have all figures zero.

    n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, n_stop_words, n_shouts (long)
    and the ratios that :data:`RULES` names. The cost of a text of n words is O(n log n).
    """
    body = F.coalesce(F.col(text), F.lit(""))
    # separate projections: each array is made once and then referred to
    step = docs.withColumn("__w", words_of(text)).withColumn("__n", F.size("__w"))
    step = step.withColumn("__h", _window_hashes(F.col("__w"), F.col("__n")))
    step = step.withColumn("__win", _positions_by_hash(F.col("__h")))
    step = step.withColumn("__rep", _repeated(F.col("__win")))
    lines = F.filter(F.split(body, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    step = step.withColumn("__lines", lines)
    r = F.col("__rep")
    covered = F.size(
        F.array_union(F.array_union(r, F.transform(r, lambda p: p + 1)), F.transform(r, lambda p: p + 2))
    )
    stop = F.size(F.filter(F.col("__w"), lambda w: w.isin(*STOP_WORDS, *[x.capitalize() for x in STOP_WORDS])))
    n, div = F.col("__n"), lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    fig = {
        "n_words": n,
        "word_chars": F.char_length(F.array_join("__w", "")),
        "n_symbols": F.regexp_count(body, F.lit("[#*$%&|<>]")),
        "n_lines": F.size("__lines"),
        "n_dup_lines": F.size("__lines") - F.size(F.array_distinct("__lines")),
        "n_repeat_words": F.when(F.size(r) == 0, F.lit(0)).otherwise(covered),
        "n_stop_words": stop,
        "n_shouts": F.regexp_count(body, F.lit("!")),
    }
    step = step.withColumn("__q", F.struct(*[v.cast("long").alias(k) for k, v in fig.items()]))
    q = lambda k: F.col(f"__q.{k}")
    ratios = {
        "mean_word_chars": div(q("word_chars"), q("n_words")),
        "symbol_ratio": div(q("n_symbols"), q("n_words")),
        "stop_ratio": div(q("n_stop_words"), q("n_words")),
        "repeat_ratio": div(q("n_repeat_words"), q("n_words")),
        "dup_line_ratio": div(q("n_dup_lines"), q("n_lines")),
        "shout_ratio": div(q("n_shouts"), q("n_words")),
    }
    out = F.struct(*[q(k).alias(k) for k in fig], *[v.alias(k) for k, v in ratios.items()])
    # Made by a generator of one element: filters on the figures stop there. Pushed below the projections
    # they would take in each array's making once for every use, and planning would not end.
    return step.select(*[F.col(f"`{c}`") for c in docs.columns], F.explode(F.array(out)).alias("quality"))


def compile_rules(rules: tuple[Rule, ...] = RULES, figures: str = "quality") -> tuple[Column, Column]:
    """(passes all rules, names of the failed rules), from the threshold table."""
    fails = []
    for rule in rules:
        value, bad = F.col(f"{figures}.{rule.metric}"), F.lit(False)
        if rule.low is not None:
            bad = bad | (value < F.lit(rule.low))
        if rule.high is not None:
            bad = bad | (value > F.lit(rule.high))
        fails.append((rule.name, bad))
    ok = F.lit(True)
    for _, bad in fails:
        ok = ok & ~bad
    names = F.filter(F.array(*[F.when(bad, F.lit(name)) for name, bad in fails]), lambda x: x.isNotNull())
    return ok, names


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """``docs`` with ``quality`` (figures), ``kept`` and ``failed_rules``.

    Rows are judged one by one: repeated rows get equal verdicts, null texts count as empty and
    fail the length rule, extra columns pass through (columns of these three names are replaced).
    """
    docs = docs.drop("quality", "kept", "failed_rules")
    ok, names = compile_rules(rules)
    return with_metrics(docs, text).withColumns({"kept": ok, "failed_rules": names})


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """The rows that pass all rules, with the columns of ``docs``."""
    return judge(docs, rules, text).filter("kept").select(*[F.col(f"`{c}`") for c in docs.columns])
