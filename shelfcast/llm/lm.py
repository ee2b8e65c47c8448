"""An interpolated modified Kneser-Ney model of word pairs, counted in Spark.

Tokens are words, A-Z as a-z, and one end for each text; the first word follows a start that is
no token. The model lies in the shared folder as arrays: words sorted by hash and dealt into
shards by hash range, so that the place of a word over all shards is its number; pairs sorted by
hash in shards of their own. Workers map these files into memory to score texts.

    P(w | u) = max(c(u w) - D(c), 0) / c(u) + g(u) P(w)
    P(w)     = max(n(w) - E(n), 0) / n + g / (V + 1)

with c the counts, n(w) the number of different words before w, n their sum, D and E three
discounts each from the counts of counts, and g what the discounts leave. Unknown words share
the last term. A word that never precedes another gives P(w).

Counting pre-aggregates in each task. Pairs are dealt by their first word, so what is needed of
it is counted in one place, but pairs of very frequent first words are dealt by both, and their
counts are added up. Shards follow the number of tokens, so none grows with the corpus.

Null and empty texts are the end alone. Repeated rows count as often as they occur. Without
training documents V and N are 0 and every token has probability 1. An empty table gives an
empty table. A column named like a result is replaced by it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm import store
from shelfcast.llm.columns import U, annotate, blocks, mix, owners, span_hashes, texts_only, word_spans
from shelfcast.session import shared_folder

FLUSH = 1 << 21  # tokens a task counts before it hands them on
WORD_SHARD = 1 << 22  # tokens for each shard of words, about
PAIR_SHARD = 1 << 22  # tokens for each shard of pairs, about
END = U(0x1D8E4E27C47D124F)


def token_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of all documents, ends included, and their number before each."""
    starts, ends, before = word_spans(data, offsets)
    words = span_hashes(data, starts, ends, lower=True)
    total = before + np.arange(len(before))
    out = np.full(total[-1], END, dtype=U)
    out[np.arange(len(words)) + owners(before)] = words
    return out, total


def tally(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and how often each occurs or the sum of its counts."""
    if counts is None:
        return np.unique(keys, return_counts=True)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[heads], np.add.reduceat(counts[order], heads) if len(keys) else counts


def shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Shards by hash range, so that words in order of shard and hash are in order of hash."""
    with np.errstate(over="ignore"):
        return ((hashes >> U(32)) * U(shards) >> U(32)).astype(np.int64)


def deal(place: np.ndarray, shards: int, *columns: np.ndarray):
    """One row of bytes for each shard that has entries."""
    order = np.argsort(place, kind="stable")
    bounds = np.searchsorted(place[order], np.arange(shards + 1))
    ordered = [c[order] for c in columns]
    return [(p, *(c[a:b].tobytes() for c in ordered)) for p, (a, b) in enumerate(zip(bounds, bounds[1:])) if a < b]


def batch_of(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.int32()] + [pa.binary()] * (len(names) - 1)
    columns = list(zip(*rows)) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def joined(pdf: pd.DataFrame, column: str, kind) -> np.ndarray:
    return np.frombuffer(b"".join(pdf[column]), dtype=kind)


def gathered(batches, texts_at: int, count: Callable[[np.ndarray, np.ndarray], tuple]):
    """What ``count(hashes, total)`` makes of each block, of about FLUSH tokens at a time. A block is
    counted before the next is read, so a task holds what is different and not every token."""
    held, size = [], 0
    for batch in batches:
        for *_, data, offsets in blocks(batch.column(texts_at)):
            hashes, total = token_hashes(data, offsets)
            held.append(count(hashes, total))
            size += len(hashes)
            if size >= FLUSH:
                yield held
                held, size = [], 0
    if held:
        yield held


def estimate(ones: np.ndarray) -> np.ndarray:
    """Three discounts from the numbers of entries that occur one to four times."""
    n1, n2, n3, n4 = (float(x) for x in ones)
    if not (n1 and n2 and n3 and n4):
        return np.array([0.0, 0.5, 1.0, 1.5])
    y = n1 / (n1 + 2 * n2)
    found = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return np.array([0.0] + [min(max(d, 0.1), k - 0.1) for k, d in enumerate(found, 1)])


@dataclass(frozen=True)
class PairModel:
    """Where the arrays are and the figures of the whole corpus."""

    folder: str
    word_shards: int
    pair_shards: int
    tokens: int
    words: int
    documents: int
    hot: int  # count from which pairs are dealt by both words
    pair_discounts: tuple[float, ...]
    word_discounts: tuple[float, ...]
    continuations: int
    left: float  # what the word discounts leave

    def discounted(self, counts: np.ndarray, discounts: tuple[float, ...]) -> np.ndarray:
        return np.maximum(counts - np.array(discounts)[np.minimum(counts, 3)], 0)


class Arrays:
    """The model's files in a worker."""

    def __init__(self, folder: str):
        self.folder, self.files = folder, {}

    def __call__(self, name: str) -> np.ndarray:
        if name not in self.files:
            self.files[name] = store.load(self.folder, name)
        return self.files[name]


@lru_cache(maxsize=2)
def arrays(folder: str) -> Arrays:
    return Arrays(folder)


def numbers(hashes: np.ndarray, folder: str, shards: int, names: tuple[str, ...] = ()) -> list[np.ndarray]:
    """Numbers of distinct, ordered hashes over all shards (-1 if unknown), and the named arrays there."""
    files = arrays(folder)
    bases = files("bases")
    out = [np.full(len(hashes), -1, dtype=np.int64)] + [np.zeros(len(hashes), dtype=np.int64) for _ in names]
    cuts = np.searchsorted(shard_of(hashes, shards), np.arange(shards + 1))
    for p in range(shards):
        a, b = cuts[p], cuts[p + 1]
        known = files(f"words-{p}") if a < b and bases[p + 1] > bases[p] else ()
        if len(known):
            at = np.minimum(np.searchsorted(known, hashes[a:b]), len(known) - 1)
            found = np.flatnonzero(known[at] == hashes[a:b])
            out[0][a + found] = bases[p] + at[found]
            for column, name in zip(out[1:], names):
                column[a + found] = files(f"{name}-{p}")[at[found]]
    return out


def pair_keys(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Hashes of pairs of word numbers."""
    with np.errstate(over="ignore"):
        return mix(mix(first.astype(U) + U(0x9E3779B97F4A7C15)) + second.astype(U) * U(0xD6E8FEB86659FD93))


def pair_places(first: np.ndarray, second: np.ndarray, counts: np.ndarray, hot: int, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of pairs of word numbers, and the shard of each."""
    key = pair_keys(first, second)
    with np.errstate(over="ignore"):
        return key, (np.where(counts >= hot, key, mix(first.astype(U) ^ U(0x3C6EF372FE94F82B))) % U(shards)).astype(np.int64)


def _pairs_of(hashes: np.ndarray, total: np.ndarray, folder: str, shards: int, start: int, documents: int):
    """Word numbers of all pairs of a block of documents, and the count of each first word."""
    distinct, place = np.unique(hashes, return_inverse=True)
    number, count = numbers(distinct, folder, shards, ("counts",))
    number, count = number[place], count[place]
    first, counted = np.empty_like(number), np.empty_like(count)
    first[1:], counted[1:] = number[:-1], count[:-1]
    first[total[:-1]], counted[total[:-1]] = start, documents
    return first, number, counted


def folded(held: list[tuple]) -> tuple[np.ndarray, ...]:
    """Different keys in order, the sums of their times, and the other columns: from such arrays of several
    blocks. ``held`` is emptied, a column at a time, so that nothing is there twice for long."""
    columns = [list(c) for c in zip(*held)]
    held.clear()
    keys, times, *others = (np.concatenate(columns.pop(0)) for _ in range(len(columns)))
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    keys, times, rows = keys[heads], np.add.reduceat(times[order], heads, dtype=np.int64), order[heads]
    del order, heads
    return keys, times, *(others.pop(0)[rows] for _ in range(len(others)))


def fit(docs: DataFrame, allowed: Column | None = None, id_column: str = "doc_id", text: str = "text") -> PairModel:
    """Count the documents that ``allowed`` admits and write the model to the shared folder."""
    spark = docs.sparkSession
    folder = f"{shared_folder(spark)}/pairs-{uuid.uuid4().hex}"
    training = texts_only(docs if allowed is None else docs.where(allowed), id_column, text)
    # Characters tell how many shards the words need before any word is counted.
    documents, size = training.agg(F.count("*"), F.sum(F.octet_length(text))).first()
    if not documents:
        return PairModel(folder, 0, 0, 0, 0, 0, 1, (0.0,) * 4, (0.0,) * 4, 0, 1.0)
    tokens_about = (size or 0) // 5 + documents
    word_shards, pair_shards = 1 + tokens_about // WORD_SHARD, 1 + tokens_about // PAIR_SHARD
    texts = training.select(text)

    def count_words(batches):
        for held in gathered(batches, 0, lambda hashes, total: tally(hashes)):
            words, counts = folded(held)
            yield batch_of(deal(shard_of(words, word_shards), word_shards, words, counts), ["shard", "words", "counts"])

    def keep_words(key, pdf: pd.DataFrame) -> pd.DataFrame:
        words, counts = tally(joined(pdf, "words", U), joined(pdf, "counts", np.int64))
        store.save(folder, f"words-{key[0]}", words)
        store.save(folder, f"counts-{key[0]}", counts)
        return pd.DataFrame({"shard": [key[0]], "words": [len(words)], "tokens": [counts.sum()]})

    sizes = texts.mapInArrow(count_words, "shard int, words binary, counts binary").groupBy("shard").applyInPandas(
        keep_words, "shard int, words bigint, tokens bigint").toPandas()
    of_shard = np.zeros(word_shards, dtype=np.int64)
    of_shard[sizes["shard"]] = sizes["words"]
    bases = np.concatenate([[0], np.cumsum(of_shard)])
    store.save(folder, "bases", bases)
    words, tokens = int(bases[-1]), int(sizes["tokens"].sum())
    hot = max(2, tokens // (8 * pair_shards))
    width = np.dtype("<u4" if words < 2**32 - 1 else "<u8")

    def count_pairs(batches):
        def count(hashes: np.ndarray, total: np.ndarray):
            first, second, counted = _pairs_of(hashes, total, folder, word_shards, words, documents)
            key, place = pair_places(first, second, counted, hot, pair_shards)
            key, at, times = np.unique(key, return_index=True, return_counts=True)
            return key, times.astype(np.uint32), first[at].astype(width), second[at].astype(width), place[at].astype(np.int32)

        for held in gathered(batches, 0, count):
            _, times, first, second, place = folded(held)
            # A count is one byte; larger ones take several entries.
            copies = (times - 1) // 255 + 1
            entry = np.repeat(np.arange(len(times)), copies)
            share = np.full(len(entry), 255, dtype=np.uint8)
            share[np.cumsum(copies) - 1] = times - 255 * (copies - 1)
            yield batch_of(deal(place[entry], pair_shards, first[entry], second[entry], share), ["shard", "first", "second", "times"])

    def keep_pairs(key, pdf: pd.DataFrame) -> pd.DataFrame:
        first, second, times = joined(pdf, "first", width), joined(pdf, "second", width), joined(pdf, "times", np.uint8)
        hashes, counts, first, second = folded([(pair_keys(first, second), times, first, second)])
        store.save(folder, f"pairs-{key[0]}", hashes)
        store.save(folder, f"times-{key[0]}", counts.astype(np.min_scalar_type(int(counts.max()))))
        first, second = first.astype(np.int64), second.astype(np.int64)
        capped = np.minimum(counts, 3)
        after, kinds = tally(first * 4 + capped)
        before, different = tally(second)
        ones = np.bincount(np.minimum(counts, 5), minlength=6)[1:5]
        rows = [(-1, np.array([key[0]], dtype=np.int64).tobytes(), ones.astype(np.int64).tobytes())]
        # Entries for the shards of words: number * 4 + kind, kind 0 for words before, 1 to 3 for
        # pairs that the word begins and that occur once, twice, more often.
        entries, values = np.concatenate([before * 4, after]), np.concatenate([different, kinds])
        place = np.searchsorted(bases, entries // 4, "right") - 1
        rows += deal(np.minimum(place, word_shards - 1), word_shards, entries, values.astype(np.int64))
        return pd.DataFrame(rows, columns=["shard", "entries", "values"])

    stats = texts.mapInArrow(count_pairs, "shard int, first binary, second binary, times binary").groupBy("shard").applyInPandas(
        keep_pairs, "shard int, entries binary, values binary")

    def keep_stats(key, pdf: pd.DataFrame) -> pd.DataFrame:
        p = key[0]
        if p < 0:
            ones = joined(pdf, "values", np.int64).reshape(-1, 4).sum(axis=0)
            store.save(folder, "present", np.sort(joined(pdf, "entries", np.int64)))
            return pd.DataFrame([["pairs", 0, *ones]], columns=["of", "total", "n1", "n2", "n3", "n4"])
        entries, values = tally(joined(pdf, "entries", np.int64), joined(pdf, "values", np.int64))
        # The start, numbered after all words, lies one beyond the last shard.
        table = np.zeros((bases[p + 1] - bases[p] + 1, 4), dtype=np.int64)
        table[entries // 4 - bases[p], entries % 4] = values
        for kind, name in enumerate(("before", "once", "twice", "more")):
            store.save(folder, f"{name}-{p}", table[:, kind].astype(np.min_scalar_type(int(table[:, kind].max()))))
        ones = np.bincount(np.minimum(table[:, 0], 5), minlength=6)[1:5]
        return pd.DataFrame([["words", table[:, 0].sum(), *ones]], columns=["of", "total", "n1", "n2", "n3", "n4"])

    figures = stats.groupBy("shard").applyInPandas(keep_stats, "of string, total bigint, n1 bigint, n2 bigint, n3 bigint, n4 bigint").groupBy(
        "of").agg(*(F.sum(c).alias(c) for c in ("total", "n1", "n2", "n3", "n4"))).toPandas().set_index("of")
    ones = ["n1", "n2", "n3", "n4"]
    pair_discounts, word_discounts = (estimate(figures.loc[of, ones].to_numpy()) for of in ("pairs", "words"))
    continuations, single = int(figures.loc["words", "total"]), figures.loc["words", ones].to_numpy()
    rest = words - int(single[:2].sum())
    left = float(word_discounts[1:] @ np.array([single[0], single[1], rest])) / continuations
    return PairModel(folder, word_shards, pair_shards, tokens, words, documents, hot, tuple(pair_discounts), tuple(word_discounts), continuations, left)


def log10_probabilities(model: PairModel, hashes: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The model's log10 probability of every token, and its count in training."""
    if not model.tokens:
        return np.zeros(len(hashes)), np.zeros(len(hashes), dtype=np.int64)
    distinct, place = np.unique(hashes, return_inverse=True)
    names = ("counts", "before", "once", "twice", "more")
    number, count, before, *kinds = numbers(distinct, model.folder, model.word_shards, names)
    lower = model.discounted(before, model.word_discounts) / model.continuations + model.left / (model.words + 1)
    left = (np.column_stack(kinds) @ np.array(model.pair_discounts[1:])) / np.maximum(count, 1)
    left[count == 0] = 1
    # Of each place: the word before it.
    files, last = arrays(model.folder), model.word_shards - 1
    start = [float(files(f"{name}-{last}")[-1]) for name in names[2:]]
    of_start = float(np.array(start) @ np.array(model.pair_discounts[1:])) / model.documents
    first, times, back = np.empty(len(hashes), np.int64), np.empty(len(hashes), np.int64), np.empty(len(hashes))
    for out, values, opening in ((first, number, model.words), (times, count, model.documents), (back, left, of_start)):
        out[1:] = values[place][:-1]
        out[total[:-1]] = opening
    second = number[place]
    high = np.zeros(len(hashes))
    known = np.flatnonzero((first >= 0) & (second >= 0))
    keys, shard = pair_places(first[known], second[known], times[known], model.hot, model.pair_shards)
    order = np.lexsort((keys, shard))
    cuts = np.searchsorted(shard[order], np.arange(model.pair_shards + 1))
    for p in files("present").tolist():
        here = order[cuts[p]:cuts[p + 1]]
        if len(here):
            pairs, held = files(f"pairs-{p}"), files(f"times-{p}")
            at = np.minimum(np.searchsorted(pairs, keys[here]), len(pairs) - 1)
            found = np.flatnonzero(pairs[at] == keys[here])
            counted = held[at[found]].astype(np.int64)
            high[known[here[found]]] = model.discounted(counted, model.pair_discounts) / times[known[here[found]]]
    return np.log10(high + back * lower[place]), count[place]


def score(docs: DataFrame, model: PairModel, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The rows with n_tokens, n_known (tokens seen in training), train_tokens, base_score
    (add-one single words) and score (the model), both log10 probabilities of the text."""
    def run(texts, data, offsets):
        hashes, total = token_hashes(data, offsets)
        found, counts = log10_probabilities(model, hashes, total)
        base = np.log10((counts + 1) / (model.tokens + model.words + 1))
        return {
            "n_tokens": np.diff(total), "n_known": np.add.reduceat((counts > 0).astype(np.int64), total[:-1]),
            "train_tokens": np.full(len(total) - 1, model.tokens, dtype=np.int64),
            "base_score": np.add.reduceat(base, total[:-1]), "score": np.add.reduceat(found, total[:-1]),
        }

    return annotate(docs, run, "n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double", text, keep)


def perplexity(scored: DataFrame) -> DataFrame:
    """The rows with ``perplexity`` for each token."""
    return scored.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
