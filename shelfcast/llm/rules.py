"""Quality rules: an ordered list of threshold conjunctions learned from labelled statistics.

Counts of every text come first, then ratios of them as Spark expressions. Rules are learned by
sequential covering: a rule grows by the threshold of highest information gain until it covers
no good document of the growing set, loses its last conditions again while that helps on the
pruning set, and the documents it covers leave both sets. Rules that are not precise enough on
the pruning set end the search. The list becomes one ordered conditional expression: the first
rule that holds rejects, and what no rule rejects is kept.

Null and empty texts have no words: all counts are 0 (one empty line). Repeated rows are counted
alike. An empty table gives an empty table. Without labels of both kinds the list is empty and
keeps everything. A column named like a result is replaced by it.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.columns import annotate, flags, line_spans, ngram_hashes, owners, repeated, running, span_hashes, sums, word_spans

ROWS = 20_000
LEAST_WORDS = 50
PRECISION, LEAST_COVERED, MOST_CONDITIONS, MOST_RULES, CUTS = 0.9, 3, 4, 16, 48

_SYMBOLS = flags(b"#*$%&|<>")
_UPPER = flags(bytes(range(65, 91)))
_CRIES = flags(b"!?")
_DIGITS = flags(bytes(range(48, 58)))
_LETTERS = flags(bytes([*range(65, 91), *range(97, 123), *range(128, 256)]))

COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_cries", "n_digits",
    "n_stutters", "n_marks",
)


def counts_of(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The counts of every document of a block.

    n_dup_lines: lines with a word, equal to an earlier line. n_repeat_words: words in windows of
    three words found twice or more in the text, the first included. n_stutters: words equal to
    the word before. n_marks: words without a letter.
    """
    starts, ends, before = word_spans(data, offsets)
    hashes, owner = span_hashes(data, starts, ends), owners(before)
    begin, end, lines = line_spans(data, offsets)
    n_in_line = np.searchsorted(starts, end) - np.searchsorted(starts, begin)
    again = repeated(span_hashes(data, begin, end), owners(lines))[1] & (n_in_line > 0)
    triples, triples_before = ngram_hashes(hashes, before, 3)
    twice = repeated(triples, owners(triples_before))[0]
    places = np.arange(len(triples)) + np.repeat(before[:-1] - triples_before[:-1], np.diff(triples_before))
    covered = np.zeros(len(hashes) + 2, dtype=bool)
    for shift in range(3):
        covered[places[twice] + shift] = True
    stutter = np.zeros(len(hashes), dtype=bool)
    stutter[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    points, lettered = running((data & 0xC0) != 0x80), running(_LETTERS[data])
    made = {
        "n_words": np.diff(before), "word_chars": sums(points[ends] - points[starts], before), "n_dup_lines": sums(again, lines),
        "n_repeat_words": sums(covered[:len(hashes)], before), "n_lines": np.diff(lines), "n_stutters": sums(stutter, before),
        "n_marks": sums(lettered[ends] == lettered[starts], before),
    }
    for name, table in (("n_symbols", _SYMBOLS), ("n_upper", _UPPER), ("n_cries", _CRIES), ("n_digits", _DIGITS)):
        made[name] = sums(table[data], offsets)
    return {name: made[name].astype(np.int64) for name in COUNTS}


def statistics(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The rows with the counts of their text."""
    return annotate(docs, lambda texts, data, offsets: counts_of(data, offsets), ", ".join(f"{c} bigint" for c in COUNTS), text, keep)


def ratios() -> dict[str, Column]:
    """What conditions may look at, from the counts."""
    def per(count: str, total: str) -> Column:
        return F.col(count) / F.greatest(F.col(total), F.lit(1))

    return {
        "n_words": F.col("n_words").cast("double"),
        "word_length": per("word_chars", "n_words"),
        "symbols_per_word": per("n_symbols", "n_words"),
        "dup_line_share": per("n_dup_lines", "n_lines"),
        "repeat_share": per("n_repeat_words", "n_words"),
        "words_per_line": per("n_words", "n_lines"),
        "upper_share": per("n_upper", "word_chars"),
        "cries_per_word": per("n_cries", "n_words"),
        "digit_share": per("n_digits", "word_chars"),
        "stutter_share": per("n_stutters", "n_words"),
        "mark_share": per("n_marks", "n_words"),
    }


@dataclass(frozen=True)
class Condition:
    name: str
    at_least: bool
    threshold: float

    def holds(self, rows: pd.DataFrame) -> np.ndarray:
        values = rows[self.name].to_numpy()
        return values >= self.threshold if self.at_least else values <= self.threshold

    def column(self, known: dict[str, Column]) -> Column:
        return known[self.name] >= F.lit(self.threshold) if self.at_least else known[self.name] <= F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.name} {'>=' if self.at_least else '<='} {self.threshold:.6g}"


@dataclass
class DecisionList:
    """Rules in order; a rule is a conjunction of conditions and rejects."""

    rules: list[list[Condition]] = field(default_factory=list)

    def keeps(self) -> Column:
        """An ordered conditional expression over the counts: false if a rule rejects."""
        known, expression = ratios(), None
        for rule in self.rules:
            holds = rule[0].column(known)
            for condition in rule[1:]:
                holds = holds & condition.column(known)
            expression = F.when(holds, False) if expression is None else expression.when(holds, False)
        return F.lit(True) if expression is None else expression.otherwise(True)

    def __str__(self) -> str:
        return "\n".join(["reject if " + " and ".join(map(str, rule)) for rule in self.rules] + ["keep"])


def covered(rule: list[Condition], rows: pd.DataFrame) -> np.ndarray:
    held = np.ones(len(rows), dtype=bool)
    for condition in rule:
        held &= condition.holds(rows)
    return held


def grow(rows: pd.DataFrame, bad: np.ndarray) -> list[Condition]:
    rule: list[Condition] = []
    while len(rule) < MOST_CONDITIONS and bad.any() and not bad.all():
        base, best, gain = np.log2(bad.mean()), None, 1e-9
        for name in rows.columns:
            values = rows[name].to_numpy()
            cuts = np.unique(np.quantile(values, np.linspace(0, 1, CUTS + 1)))
            for cut in (cuts[1:] + cuts[:-1]) / 2:
                above = values >= cut
                for at_least, held in ((True, above), (False, ~above)):
                    p = int((held & bad).sum())
                    if p >= LEAST_COVERED and (found := p * (np.log2(p / held.sum()) - base)) > gain:
                        best, gain = Condition(name, at_least, float(cut)), found
        if best is None:
            break
        rule.append(best)
        held = best.holds(rows)
        rows, bad = rows[held], bad[held]
    return rule


def prune(rule: list[Condition], rows: pd.DataFrame, bad: np.ndarray) -> list[Condition]:
    def worth(size: int) -> float:
        held = covered(rule[:size], rows)
        p, n = int((held & bad).sum()), int((held & ~bad).sum())
        return (p - n) / (p + n) if p + n else -1.0

    return rule[:max(range(1, len(rule) + 1), key=lambda size: (worth(size), -size))] if rule else rule


def learn(rows: pd.DataFrame, rejected: np.ndarray) -> DecisionList:
    """Rules from one row of ratios for each labelled document."""
    pruning = np.arange(len(rows)) % 3 == 0
    grown, grown_bad, pruned, pruned_bad = rows[~pruning], rejected[~pruning], rows[pruning], rejected[pruning]
    made = DecisionList()
    while len(made.rules) < MOST_RULES and grown_bad.any() and pruned_bad.any():
        rule = prune(grow(grown, grown_bad), pruned, pruned_bad)
        held = covered(rule, pruned)
        caught = int((held & pruned_bad).sum())
        # One more of either kind than was seen, so that a few hits alone prove no rule.
        if not rule or caught < LEAST_COVERED or caught + 1 < PRECISION * (held.sum() + 2):
            break
        made.rules.append(rule)
        left = ~covered(rule, grown)
        grown, grown_bad, pruned, pruned_bad = grown[left], grown_bad[left], pruned[~held], pruned_bad[~held]
    return made


def fit(
    docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = ROWS, id_column: str = "doc_id", text: str = "text",
) -> DecisionList:
    """Learn from at most ``rows`` labelled documents, chosen by hash; label 0 is to be rejected.
    The chosen ids are few by construction and go to all tasks; only numbers come back."""
    chosen = labels.where(F.col(label).isin(0, 1) & F.col(id_column).isNotNull()).groupBy(id_column).agg(
        F.max(label).cast("int").alias("__label")).orderBy(F.xxhash64(id_column), id_column).limit(rows)
    marked = docs.select(id_column, F.col(text).alias("text")).where(F.col("text").isNotNull()).join(F.broadcast(chosen), id_column)
    counted = statistics(marked, "text", [id_column, "__label"])
    known = ratios()
    found = counted.select(id_column, "__label", *(c.alias(f"r_{name}") for name, c in known.items()))
    once = found.groupBy(id_column).agg(F.min(F.struct(*found.columns[1:])).alias("s")).orderBy(F.xxhash64(id_column)).select("s.*").toPandas()
    return learn(once.drop(columns="__label").rename(columns=lambda c: c[2:]), once["__label"].to_numpy() == 0)


def judge(docs: DataFrame, decisions: DecisionList, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The rows with the counts, ``base_failed`` (too few words, or most of them in repeated
    windows) and ``verdict`` (the list's own, whatever the base says)."""
    counted = statistics(docs, text, keep)
    return counted.withColumns({
        "base_failed": (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")),
        "verdict": decisions.keeps(),
    })
