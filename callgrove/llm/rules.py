"""Quality rules: statistics of a text in Spark expressions, and a learned decision list.

The list is learned by sequential covering. A rule is a conjunction of thresholds on the
statistics; it grows literal by literal to exclude good texts from what it covers, is
pruned against rows that growing did not see, and goes to the list if it is precise
enough; what it covers is then set aside. The list is emitted as one Spark conditional
expression: the first rule that holds rejects, the default keeps.

Nulls: a null text has no words. Statistics that are shares are 0 where there is nothing
to divide by. Labels that are null, not 0 or 1, or both for one id are not used; without
any rejected label the list is empty and keeps all. Repeated rows are judged alike; an
empty table gives no rows; columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from callgrove.llm.common import WHITE_SPACE, table, words_of
from callgrove.llm.labelled import balanced_sample, labels_of

#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"
#: Bound of the labelled sample: rows of either label that the learner takes.
PER_CLASS = 4000
FOLDS, HELD_OUT = 4, 2
#: Statistics that rules may test.
FEATURES = (
    "n_words", "mean_word", "symbol_share", "line_share", "repeat_share", "upper_share",
    "mark_share", "digit_share", "echo_share",
)
MAX_RULES, MAX_LITERALS, MIN_PRECISION = 16, 3, 0.9


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def repeated_words(words: Column, size: int = 3) -> Column:
    """Words inside windows of ``size`` words that occur twice or more in the text."""

    def of_windows(hashes: Column) -> Column:
        def covered(s: Column) -> Column:
            twice = F.filter(
                s,
                lambda e, i: ((i > 0) & (e["h"] == F.get(s, i - 1)["h"]))
                | ((i < F.size(s) - 1) & (e["h"] == F.get(s, i + 1)["h"])),
            )
            places = F.array_sort(F.transform(twice, lambda e: e["p"]))
            return F.element_at(F.transform(F.array(places), spanned), 1)

        def spanned(p: Column) -> Column:
            lengths = F.transform(
                p, lambda x, i: F.least(F.lit(size), F.coalesce(F.get(p, i + 1) - x, F.lit(size)))
            )
            return F.aggregate(lengths, F.lit(0), lambda n, x: n + x)

        placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(
            F.element_at(F.transform(F.array(placed), covered), 1)
        )

    def bound(w: Column) -> Column:
        spans = F.sequence(F.lit(0), F.size(w) - size)
        hashes = F.transform(spans, lambda i: F.xxhash64(*(F.get(w, i + j) for j in range(size))))
        return F.element_at(F.transform(F.array(hashes), of_windows), 1)

    return F.element_at(
        F.transform(F.array(words), lambda w: F.when(F.size(w) < size, F.lit(0)).otherwise(bound(w))), 1
    )


def statistics(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) as counts and the shares that rules test."""
    text = F.coalesce("text", F.lit(""))
    echoes = F.element_at(
        F.transform(
            F.array("_words"),
            lambda w: F.size(F.filter(w, lambda x, i: (i > 0) & (x == F.get(w, i - 1)))),
        ),
        1,
    )
    rows = docs.select("doc_id", *(c for c in docs.columns if c == "y"), text.alias("_text"))
    rows = rows.withColumns(
        {
            "_words": words_of(F.col("_text")),
            "_solid": _without(F.col("_text"), WHITE_SPACE),
            "_lines": lines_of(F.col("_text")),
        }
    )
    size = F.length("_text")
    counted = rows.select(
        "doc_id",
        *(c for c in docs.columns if c == "y"),
        F.size("_words").cast("long").alias("n_words"),
        F.length("_solid").cast("long").alias("word_chars"),
        (size - F.length(_without(F.col("_text"), SYMBOLS))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("_words")).cast("long").alias("n_repeat_words"),
        F.size("_lines").alias("_n_lines"),
        (F.length("_solid") - F.length(F.regexp_replace("_solid", r"\p{Lu}+", ""))).alias("_upper"),
        (F.length("_solid") - F.length(_without(F.col("_solid"), "!?."))).alias("_marks"),
        (F.length("_solid") - F.length(_without(F.col("_solid"), "0123456789"))).alias("_digits"),
        echoes.alias("_echoes"),
    )
    return counted.select(
        "*",
        _share(F.col("word_chars"), F.col("n_words")).alias("mean_word"),
        _share(F.col("n_symbols"), F.col("word_chars")).alias("symbol_share"),
        _share(F.col("n_dup_lines"), F.col("_n_lines")).alias("line_share"),
        _share(F.col("n_repeat_words"), F.col("n_words")).alias("repeat_share"),
        _share(F.col("_upper"), F.col("word_chars")).alias("upper_share"),
        _share(F.col("_marks"), F.col("word_chars")).alias("mark_share"),
        _share(F.col("_digits"), F.col("word_chars")).alias("digit_share"),
        _share(F.col("_echoes"), F.col("n_words")).alias("echo_share"),
    )


def lines_of(text: Column) -> Column:
    """Lines that hold a word."""
    return F.filter(F.split(text, "\n"), lambda line: _without(line, WHITE_SPACE) != "")


@dataclass(frozen=True)
class Literal:
    feature: str
    above: bool
    threshold: float

    def holds(self, values: np.ndarray) -> np.ndarray:
        column = values[:, FEATURES.index(self.feature)]
        return column >= self.threshold if self.above else column < self.threshold

    def column(self) -> Column:
        value = F.col(self.feature)
        return value >= self.threshold if self.above else value < self.threshold


Rule = tuple[Literal, ...]


def _covers(rule: Rule, values: np.ndarray) -> np.ndarray:
    return reduce(np.logical_and, (literal.holds(values) for literal in rule), np.ones(len(values), bool))


def _candidates(values: np.ndarray) -> list[Literal]:
    found = []
    for k, name in enumerate(FEATURES):
        points = np.unique(np.quantile(values[:, k], np.linspace(0.01, 0.99, 49)))
        for point in points:
            found += [Literal(name, True, float(point)), Literal(name, False, float(point))]
    return found


def _grow(values: np.ndarray, bad: np.ndarray) -> Rule:
    """Add the literal of the highest information gain until no good row is covered."""
    rule: Rule = ()
    inside = np.ones(len(values), bool)
    while len(rule) < MAX_LITERALS:
        p, n = bad[inside].sum(), (~bad[inside]).sum()
        if p == 0 or n == 0:
            break
        base = np.log2(p / (p + n))
        best, gain = None, 1e-9
        for literal in _candidates(values[inside]):
            covered = literal.holds(values[inside])
            q = bad[inside][covered].sum()
            m = covered.sum() - q
            if q and (won := q * (np.log2(q / (q + m)) - base)) > gain:
                best, gain = literal, won
        if best is None:
            break
        rule += (best,)
        inside &= best.holds(values)
    return rule


def _prune(rule: Rule, values: np.ndarray, bad: np.ndarray) -> Rule:
    """Drop final literals while (bad - good) / (bad + good) of the covered rows does not fall."""

    def worth(r: Rule) -> float:
        covered = _covers(r, values)
        p, n = bad[covered].sum(), (~bad[covered]).sum()
        return (p - n) / (p + n) if p + n else -1.0

    while len(rule) > 1 and worth(rule[:-1]) >= worth(rule):
        rule = rule[:-1]
    return rule


def learn(values: np.ndarray, bad: np.ndarray, weight_good: float = 1.0) -> list[Rule]:
    """Ordered rules that reject. ``weight_good`` undoes the balance of the sample."""
    rules: list[Rule] = []
    part = np.random.default_rng(5).permutation(len(values)) % 3 == 0
    left = np.ones(len(values), bool)
    while len(rules) < MAX_RULES and bad[left & ~part].any():
        rule = _grow(values[left & ~part], bad[left & ~part])
        if not rule:
            break
        rule = _prune(rule, values[left & part], bad[left & part])
        covered = _covers(rule, values) & left
        p, n = bad[covered].sum(), (~bad[covered]).sum() * weight_good
        if p < 5 or p < MIN_PRECISION * (p + n):
            break
        rules.append(rule)
        left &= ~covered
    return rules


def fit(spark: SparkSession, sf_dir: str, per_class: int = PER_CLASS) -> list[Rule]:
    """Rules learned from the statistics of a bounded labelled sample."""
    labels = labels_of(spark, sf_dir, "quality", FOLDS, HELD_OUT)
    sample, share = balanced_sample(labels, per_class)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    rows = statistics(docs).select("y", *FEATURES).collect()
    if not rows:
        return []
    table_ = np.array(sorted(tuple(float(v) for v in row) for row in rows))
    bad = table_[:, 0] == 0
    ratio = (bad.sum() / max(1, (~bad).sum())) * share / max(1e-9, 1 - share)
    return learn(table_[:, 1:], bad, max(1.0, ratio))


def verdict(rules: list[Rule]) -> Column:
    """True where no rule of the list holds, as one ordered conditional expression."""
    if not rules:
        return F.lit(True)
    expression = None
    for rule in rules:
        condition = reduce(lambda a, b: a & b, (literal.column() for literal in rule))
        expression = F.when(condition, False) if expression is None else expression.when(condition, False)
    return expression.otherwise(True)


def described(rules: list[Rule]) -> list[str]:
    """Rules as text, in order."""
    return [
        " and ".join(f"{x.feature} {'>=' if x.above else '<'} {x.threshold:g}" for x in rule) + " -> reject"
        for rule in rules
    ]


def op7_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = fit(spark, sf_dir)
    rows = statistics(table(spark, sf_dir, "documents").select("doc_id", "text"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return rows.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & verdict(rules)).alias("kept"),
    )
