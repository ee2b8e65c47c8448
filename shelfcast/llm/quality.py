"""Document quality from lines that a conditional random field labels good or bad.

Every line has features of its own and of the lines before and after it. The field is fitted on
lines that start with the label of their document and are relabelled once by the fitted field
(a bad document may hold good lines). Length-weighted probabilities of good lines average to one
figure, which a logistic curve fitted on the same sample turns into the score.

A null or empty text is one empty line and gets a score like any other. Repeated rows are scored
alike. An empty table gives an empty table. Without labels of both kinds every document gets the
share of label 1 (0.5 without any). A column named like a result is replaced by it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame

from shelfcast.llm import crf
from shelfcast.llm.columns import annotate, blocks, flags, line_spans, ngram_hashes, owners, repeated, running, span_hashes, word_spans
from shelfcast.llm.labelled import sample

ROWS, MOST_CHARS = 4000, 100_000
THRESHOLD = 0.3
BLOCK = 1 << 18  # bytes of text that are scored at once; a line has some 150 features of eight bytes

_LETTERS = flags(bytes([*range(65, 91), *range(97, 123), *range(128, 256)]))
_PLAIN = flags(bytes([*range(65, 91), *range(97, 123)]))
_UPPER = flags(bytes(range(65, 91)))
_DIGITS = flags(bytes(range(48, 58)))
_SYMBOLS = flags(b"#*$%&|<>@^~=+_{}[]\\/")
_CRIES = flags(b"!?")
_ENDS = flags(b".!?:;\"')")
_CUTS = (0.03, 0.1, 0.3, 0.6)


def line_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all lines, the weight (bytes + 1) of each, and the lines before each document."""
    starts, ends, before = line_spans(data, offsets)
    size = ends - starts
    at, to, words_before = word_spans(data, offsets)
    hashes, owner = span_hashes(data, at, to), owners(words_before)
    first, last = np.searchsorted(at, starts), np.searchsorted(at, ends)
    n_words = last - first

    def share(table: np.ndarray) -> np.ndarray:
        counted = running(table[data])
        return counted[ends] - counted[starts]

    def words(flagged: np.ndarray) -> np.ndarray:
        counted = running(flagged)
        return (counted[last] - counted[first]) / np.maximum(n_words, 1)

    lettered = running(_LETTERS[data])
    same = np.zeros(len(hashes), dtype=bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    line_of_word = np.searchsorted(starts, at, "right") - 1
    in_line = repeated(hashes, line_of_word)[1]
    triples, triples_before = ngram_hashes(hashes, words_before, 3)
    twice = repeated(triples, owners(triples_before))[0]
    covered = np.zeros(len(hashes) + 1, dtype=bool)
    places = np.arange(len(triples)) + np.repeat(words_before[:-1] - triples_before[:-1], np.diff(triples_before))
    covered[places[twice]] = True
    line_hashes = span_hashes(data, starts, ends)
    line_twice = repeated(line_hashes, owners(before))[0] & (n_words > 0)
    chars, letters = np.maximum(size, 1), share(_LETTERS)
    tail = np.zeros(len(starts), dtype=bool)
    tail[size > 0] = _ENDS[data[ends[size > 0] - 1]]
    shares = [
        1 - letters / chars, share(_UPPER) / np.maximum(share(_PLAIN), 1), share(_SYMBOLS) / chars, share(_CRIES) / chars,
        share(_DIGITS) / chars, words(same), words(in_line), words(covered[:-1]),
        words(lettered[to] == lettered[at]), line_twice.astype(float),
    ]
    base = np.column_stack([
        n_words == 0, np.log1p(size) / 5, np.log1p(n_words) / 3, size / np.maximum(n_words, 1) / 10, tail,
        *shares, *(s > c for s in shares[:-1] for c in _CUTS),
    ]).astype(np.float64)
    base[:, 3] = np.minimum(base[:, 3], 3)
    heads, tails = np.zeros(len(starts), dtype=bool), np.zeros(len(starts), dtype=bool)
    heads[before[:-1]], tails[before[1:] - 1] = True, True
    earlier, later = np.zeros_like(base), np.zeros_like(base)
    earlier[1:], later[:-1] = base[:-1], base[1:]
    earlier[heads], later[tails] = 0, 0
    return np.column_stack([np.ones(len(starts)), heads, tails, base, earlier, later]), size + 1, before


@dataclass
class QualityModel:
    """A fitted field and the curve from the share of good text to the score."""

    chain: crf.Chain | None
    curve: np.ndarray
    share: float

    def good_share(self, features: np.ndarray, weight: np.ndarray, before: np.ndarray) -> np.ndarray:
        good = crf.marginals(self.chain.scores(features), before, self.chain.steps)
        return np.diff(running(good * weight)[before]) / np.diff(running(weight)[before])

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        if self.chain is None:
            return np.full(len(offsets) - 1, self.share)
        return crf.sigmoid(self.curve[0] * crf.logit(self.good_share(*line_features(data, offsets)), 1e-4) + self.curve[1])


def fit_sample(rows: pd.DataFrame) -> QualityModel:
    """Fit on rows with text and label."""
    labels = rows["label"].to_numpy(dtype=np.int64)
    share = float(labels.mean()) if len(labels) else 0.5
    if len(set(labels.tolist())) < 2:
        return QualityModel(None, np.zeros(2), share)
    parts = [line_features(d, o) for *_, d, o in blocks(pa.array(rows["text"], pa.string()))]
    features, weight = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    before = np.concatenate([[0], np.cumsum(np.concatenate([np.diff(p[2]) for p in parts]))])
    document = np.repeat(labels, np.diff(before))
    chain = crf.fit(features, document, before, iterations=40)
    good = crf.marginals(chain.scores(features), before, chain.steps)
    chain = crf.fit(features, np.where(document == 1, 1, good > 0.5), before, iterations=30, start=chain)
    model = QualityModel(chain, np.zeros(2), share)
    shares = model.good_share(features, weight, before)
    model.curve = crf.calibrate(crf.logit(shares, 1e-4)[:, None], labels)
    return model


def fit(
    docs: DataFrame, labels: DataFrame, label: str = "quality", allowed: Column | None = None, rows: int = ROWS,
    most_chars: int = MOST_CHARS, id_column: str = "doc_id", text: str = "text",
) -> QualityModel:
    """Fit on at most ``rows`` labelled documents of at most ``most_chars`` characters."""
    return fit_sample(sample(docs, labels, label, rows, most_chars, allowed, id_column, text))


def score(docs: DataFrame, model: QualityModel, threshold: float = THRESHOLD, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The rows with ``score`` (0 to 1, higher is better) and ``predicted`` (1 from the threshold)."""
    def run(texts, data, offsets):
        scores = model.score(data, offsets)
        return {"score": scores, "predicted": (scores >= threshold).astype(np.int32)}

    return annotate(docs, run, "score double, predicted int", text, keep, BLOCK)


def line_labels(text: str, model: QualityModel) -> list[tuple[str, float]]:
    """Every line of one text with its probability of being good."""
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    features, _, before = line_features(data, np.array([0, len(data)]))
    return list(zip(text.split("\n"), crf.marginals(model.chain.scores(features), before, model.chain.steps).tolist()))
