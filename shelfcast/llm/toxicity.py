"""Toxic spans and document scores from a conditional random field over words.

Words are runs of letters, A-Z as a-z. The evidence of a word, or of the first bytes of one (a
stem takes many endings), is the log-odds of toxic documents among the distinct pairs of
neighbours it has in the labelled sample: copies of one passage repeat the same neighbours and
so count once. A word has the strongest evidence of itself and its beginnings. Words of strong evidence in toxic documents are
the labelled tokens on which the field is fitted; its features are steps of evidence.

A text is tagged exactly without visiting every word: words without evidence all have the same
score, so a run of them is a power of one 2 x 2 matrix between the words that have some.
Probabilities aggregate to the largest one and the expected number and share of toxic words; a
logistic curve, fitted on sampled documents that gave no evidence, turns these into the score.

Null and empty texts have no words and get the score of no evidence. Repeated rows are scored
alike. An empty table gives an empty table. Without labels of both kinds every document gets the
share of label 1 (0 without any). A column named like a result is replaced by it.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame

from shelfcast.llm import crf
from shelfcast.llm.columns import U, annotate, blocks, flags, mix, owners, prefix_hashes, running, span_hashes, word_spans
from shelfcast.llm.labelled import sample

ROWS, MOST_CHARS, MOST_TOTAL = 6000, 50_000, 24_000_000
THRESHOLD = 0.7
STEPS = (1.0, 1.75, 2.5, 3.25, 4.0)
LABELLED = 3.0  # evidence from which a word of a toxic document is a toxic token
PRIOR = 4.0
AROUND = 8
PREFIXES = range(3, 11)
_SEPARATOR = ~flags(bytes([*range(65, 91), *range(97, 123), *range(128, 256)]))


def tokens(data: np.ndarray, offsets: np.ndarray):
    """Starts and ends of words, their number before each document, and rows of hashes: of the
    words, then of their prefixes by length."""
    starts, ends, before = word_spans(data, offsets, _SEPARATOR)
    whole = span_hashes(data, starts, ends, lower=True)
    return starts, ends, before, np.vstack([whole[None], prefix_hashes(data, starts, ends, PREFIXES, lower=True)])


def rows_of_hashes(spans: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Iterator[np.ndarray]:
    """The rows of hashes of several blocks (bytes, starts, ends), one row at a time."""
    yield np.concatenate([span_hashes(*span, lower=True) for span in spans])
    for length in PREFIXES:
        yield np.concatenate([prefix_hashes(*span, range(length, length + 1), lower=True)[0] for span in spans])


def contexts(hashes: np.ndarray, before: np.ndarray) -> np.ndarray:
    """A hash of the words before and after each word of the same document."""
    owner = owners(before)
    left, right = np.zeros(len(hashes), dtype=U), np.zeros(len(hashes), dtype=U)
    same = owner[1:] == owner[:-1]
    left[1:][same], right[:-1][same] = hashes[:-1][same], hashes[1:][same]
    with np.errstate(over="ignore"):
        return mix(left * U(0x9E3779B97F4A7C15) + right)


@dataclass
class ToxicityModel:
    """Words with evidence (sorted hashes), the fitted field and the curve."""

    words: np.ndarray
    evidence: np.ndarray
    chain: crf.Chain | None
    curve: np.ndarray
    share: float

    def __post_init__(self):
        self.maybe = np.zeros(1 << 16, dtype=bool)
        self.maybe[(self.words & U(0xFFFF)).astype(np.int64)] = True

    def look_up(self, hashes: Iterable[np.ndarray], n: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of words with evidence, and the evidence, from rows of hashes of n words."""
        strongest = np.zeros(n)
        for row in hashes if len(self.words) else ():
            at = np.flatnonzero(self.maybe[(row & U(0xFFFF)).astype(np.int64)])
            where = np.minimum(np.searchsorted(self.words, row[at]), len(self.words) - 1)
            found = self.words[where] == row[at]
            strongest[at[found]] = np.maximum(strongest[at[found]], self.evidence[where[found]])
        at = np.flatnonzero(strongest)
        return at, strongest[at]

    def tag(self, hashes: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of words with evidence, their probabilities, and their number before each document."""
        return self.tag_found(*self.look_up(hashes, hashes.shape[1]), before)

    def tag_found(self, at: np.ndarray, evidence: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        listed = np.searchsorted(at, before)
        scores = self.chain.scores(steps_of(evidence))
        owner = owners(listed)
        previous = np.concatenate([[-1], at[:-1]])
        heads = np.searchsorted(owner, np.unique(owner))
        previous[heads] = before[owner[heads]] - 1
        closing = np.diff(before)
        full = np.flatnonzero(np.diff(listed))
        closing[full] = before[full + 1] - 1 - at[listed[full + 1] - 1]
        between = crf.runs_between(float(self.chain.scores(steps_of(np.zeros(1)))[0]), self.chain.steps, at - previous - 1, closing)
        return at, crf.marginals(scores, listed, self.chain.steps, between), listed

    def score(self, found: np.ndarray, listed: np.ndarray, before: np.ndarray) -> np.ndarray:
        return crf.sigmoid(summaries(found, listed, before) @ self.curve[:-1] + self.curve[-1])


def steps_of(evidence: np.ndarray) -> np.ndarray:
    return np.column_stack([np.ones(len(evidence)), *(evidence >= s for s in STEPS)]).astype(np.float64)


def summaries(found: np.ndarray, listed: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Of every document: log-odds of its likeliest word, log of 1 + the expected toxic words,
    and log of 1 + those in a hundred words."""
    highest = np.zeros(len(listed) - 1)
    full = np.diff(listed) > 0
    if full.any():
        highest[full] = np.maximum.reduceat(found, listed[:-1][full])
    expected = np.diff(running(found)[listed])
    return np.column_stack([crf.logit(highest, 1e-4), np.log1p(expected), np.log1p(100 * expected / np.maximum(np.diff(before), 1))])


def weigh(hashes: np.ndarray, around: np.ndarray, toxic: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words whose log-odds reach the first step, and the log-odds."""
    with np.errstate(over="ignore"):
        key = mix(hashes) ^ (around * U(0x9FB21C651E98DF25)) ^ toxic.astype(U)
    _, first = np.unique(key, return_index=True)
    words, place = np.unique(hashes[first], return_inverse=True)
    for_it = np.bincount(place, weights=toxic[first], minlength=len(words))
    total = np.bincount(place, minlength=len(words))
    share = float(np.clip(for_it.sum() / max(total.sum(), 1), 1e-3, 0.5))
    evidence = crf.logit((for_it + PRIOR * share) / (total + PRIOR)) - crf.logit(share)
    held = evidence >= STEPS[0]
    return words[held], evidence[held]


def fit_sample(rows: pd.DataFrame) -> ToxicityModel:
    """Fit on rows with text and label: evidence and field on two thirds, the curve on the rest."""
    labels = rows["label"].to_numpy(dtype=np.int64)
    share = float(labels.mean()) if len(labels) else 0.0
    nothing = ToxicityModel(np.zeros(0, dtype=U), np.zeros(0), None, np.zeros(4), share)
    learn = np.arange(len(labels)) % 3 > 0
    if min(len(set(labels[learn].tolist())), len(set(labels[~learn].tolist()))) < 2:
        return nothing
    # Hashes are made a row at a time, and again when they are looked up: all rows at once would
    # take many times the memory of the texts.
    spans, counts = [], []
    for *_, data, offsets in blocks(pa.array(rows["text"], pa.string())):
        starts, ends, words_before = word_spans(data, offsets, _SEPARATOR)
        spans.append((data, starts, ends))
        counts.append(np.diff(words_before))
    before = np.concatenate([[0], np.cumsum(np.concatenate(counts))])
    owner = owners(before).astype(np.int32)
    toxic, use = labels[owner].astype(np.int8), learn[owner]
    around, weighed = None, []
    for row in rows_of_hashes(spans):
        around = contexts(row, before) if around is None else around
        held = use & (row != 0)
        weighed.append(weigh(row[held], around[held], toxic[held]))
    del around, held, row
    words, evidence = (np.concatenate(part) for part in zip(*weighed))
    order = np.argsort(words)
    model = ToxicityModel(words[order], evidence[order], None, np.zeros(4), share)
    at, strength = model.look_up(rows_of_hashes(spans), len(owner))
    if not (use[at] & (toxic[at] == 1) & (strength >= LABELLED)).any():
        return nothing
    # The field sees the words near any evidence; the rest differ in nothing.
    near = np.zeros(len(owner), dtype=bool)
    for shift in range(-AROUND, AROUND + 1):
        moved = at[use[at]] + shift
        moved = moved[(moved >= 0) & (moved < len(owner))]
        near[moved] = use[moved]
    all_evidence = np.zeros(len(owner))
    all_evidence[at] = strength
    kept = np.flatnonzero(near)
    cut = np.concatenate([[True], (np.diff(kept) > 1) | (np.diff(owner[kept]) > 0)])
    bounds = np.concatenate([np.flatnonzero(cut), [len(kept)]])
    marked = (toxic[kept] == 1) & (all_evidence[kept] >= LABELLED)
    model.chain = crf.fit(steps_of(all_evidence[kept]), marked, bounds, iterations=60)
    _, found, listed = model.tag_found(at, strength, before)
    model.curve = crf.calibrate(summaries(found, listed, before)[~learn], labels[~learn], penalty=1e-1)
    return model


def fit(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", allowed: Column | None = None, rows: int = ROWS,
    most_chars: int = MOST_CHARS, id_column: str = "doc_id", text: str = "text", most_total: int = MOST_TOTAL,
) -> ToxicityModel:
    """Fit on at most ``rows`` labelled documents of at most ``most_chars`` characters each and
    ``most_total`` in all; about 20 bytes of memory are taken for each character."""
    return fit_sample(sample(docs, labels, label, rows, most_chars, allowed, id_column, text, most_total))


def score(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The rows with ``score`` (0 to 1, higher is more toxic), ``predicted`` (1 from the
    threshold) and ``spans``: neighbouring words of probability 0.5 or more, as code points from
    and to in the text with the largest probability."""
    def run(texts, data, offsets):
        starts, ends, before, hashes = tokens(data, offsets)
        if model.chain is None:
            scores = np.full(len(offsets) - 1, model.share)
            spans = [[] for _ in scores]
        else:
            at, found, listed = model.tag(hashes, before)
            scores = model.score(found, listed, before)
            points = running((data & 0xC0) != 0x80)
            spans = [spans_of(at[a:b], found[a:b], starts, ends, points, o) for a, b, o in zip(listed, listed[1:], offsets)]
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
        return {"score": scores, "predicted": (scores >= threshold).astype(np.int32), "spans": pa.array(spans, kind)}

    return annotate(docs, run, "score double, predicted int, spans array<struct<start:bigint,end:bigint,score:double>>", text, keep)


def spans_of(at, found, starts, ends, points, offset) -> list[dict]:
    spans: list[dict] = []
    last = -2
    for place, p in zip(at[found >= 0.5].tolist(), found[found >= 0.5].tolist()):
        end = int(points[ends[place]] - points[offset])
        if place == last + 1:
            spans[-1] |= {"end": end, "score": max(spans[-1]["score"], p)}
        else:
            spans.append({"start": int(points[starts[place]] - points[offset]), "end": end, "score": p})
        last = place
    return spans
