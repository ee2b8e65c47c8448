"""Helpers shared by the operators: whole Arrow text columns as bytes, words, lines and hashes.

All functions work on a block of documents: ``data`` is the block's UTF-8 bytes and ``offsets``
the place of each document in it. A block holds a few megabytes, or one longer document, so the
memory of a task does not depend on how many rows come in one Arrow batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCK = 2 << 20

# White space between words, [\x20\x09-\x0D].
SPACES = bytes([0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])

U = np.uint64
_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x.astype(U, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> U(30)
        x *= U(0xBF58476D1CE4E5B9)
        x ^= x >> U(27)
        x *= U(0x94D049BB133111EB)
        x ^= x >> U(31)
    return x


def flags(members: bytes) -> np.ndarray:
    """A table over byte values that is true for the given ones."""
    table = np.zeros(256, dtype=bool)
    table[list(members)] = True
    return table


_RAW = mix(np.arange(1, 257, dtype=U) * U(0xD1342543DE82EF95))
_LOWER = _RAW.copy()
_LOWER[65:91] = _RAW[97:123]
_SEPARATOR = flags(SPACES)
_powers = [np.ones(1, dtype=U), np.ones(1, dtype=U)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        for k, base in enumerate((_BASE, _INVERSE)):
            with np.errstate(over="ignore"):
                _powers[k] = np.concatenate([[U(1)], np.cumprod(np.full(size - 1, base, dtype=U))])
    return _powers[0], _powers[1]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False, piece: int = 1 << 17) -> np.ndarray:
    """A 64-bit hash of the bytes of every span. Spans are in order; A-Z count as a-z if ``lower``."""
    table, out, at = _LOWER if lower else _RAW, np.zeros(len(starts), dtype=U), 0
    with np.errstate(over="ignore"):
        while at < len(starts):
            first = starts[at]
            to = max(at + 1, int(np.searchsorted(ends, first + piece, "right")))
            up, down = _power_tables(int(ends[to - 1] - first) + 1)
            sums = np.zeros(int(ends[to - 1] - first) + 1, dtype=U)
            np.cumsum(table[data[first:ends[to - 1]]] * up[:len(sums) - 1], out=sums[1:])
            s, e = starts[at:to] - first, ends[at:to] - first
            out[at:to] = (sums[e] - sums[s]) * down[s]
            at = to
    return mix(out)


def prefix_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lengths: range, lower: bool = False, piece: int = 1 << 17) -> np.ndarray:
    """A row of 64-bit hashes for each length: of the first so many bytes of every span, 0 for
    spans that are not longer. Prefixes never share a hash with whole spans."""
    table, out, at = _LOWER if lower else _RAW, np.zeros((len(lengths), len(starts)), dtype=U), 0
    with np.errstate(over="ignore"):
        while at < len(starts):
            first = starts[at]
            to = max(at + 1, int(np.searchsorted(ends, first + piece, "right")))
            up, down = _power_tables(int(ends[to - 1] - first) + 1)
            sums = np.zeros(int(ends[to - 1] - first) + 1, dtype=U)
            np.cumsum(table[data[first:ends[to - 1]]] * up[:len(sums) - 1], out=sums[1:])
            s, size = starts[at:to] - first, ends[at:to] - starts[at:to]
            base, scale = sums[s], down[s]
            for k, length in enumerate(lengths):
                long = np.flatnonzero(size > length)
                out[k, at + long] = (sums[s[long] + length] - base[long]) * scale[long]
            at = to
    for row in out:
        there = row != 0
        row[there] = mix(row[there] ^ U(0xA0761D6478BD642F))
    return out


def word_spans(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = _SEPARATOR) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and the number of words before each document (and in all)."""
    inside = ~separator[data]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def line_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the lines (split at ``\\n``; an empty text is one empty line), and the
    number of lines before each document."""
    breaks = np.flatnonzero(data == 10)
    owner = np.searchsorted(offsets, breaks, "right") - 1
    documents = len(offsets) - 1
    counts = np.bincount(owner, minlength=documents) + 1
    before = np.concatenate([[0], np.cumsum(counts)])
    starts, ends = np.empty(before[-1], dtype=np.int64), np.empty(before[-1], dtype=np.int64)
    heads = np.zeros(before[-1], dtype=bool)
    heads[before[:-1]] = True
    tails = np.zeros(before[-1], dtype=bool)
    tails[before[1:] - 1] = True
    starts[heads], starts[~heads] = offsets[:-1], breaks + 1
    ends[tails], ends[~tails] = offsets[1:], breaks
    return starts, ends, before


def ngram_hashes(words: np.ndarray, before: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n consecutive words inside a document, and the number before each document."""
    counts = np.maximum(np.diff(before) - (n - 1), 0)
    total = np.concatenate([[0], np.cumsum(counts)])
    at = np.arange(total[-1]) + np.repeat(before[:-1] - total[:-1], counts)
    out = np.zeros(len(at), dtype=U)
    with np.errstate(over="ignore"):
        for k in range(n):
            out = out * U(0xD6E8FEB86659FD93) + words[at + k]
    return mix(out), total


def running(values: np.ndarray) -> np.ndarray:
    """Sums before each place, and of all."""
    out = np.zeros(len(values) + 1, dtype=np.int64 if values.dtype.kind in "bui" else np.float64)
    np.cumsum(values, out=out[1:])
    return out


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of the values between consecutive bounds."""
    return np.diff(running(values)[bounds])


def owners(before: np.ndarray) -> np.ndarray:
    """The document of every item, from the number of items before each document."""
    return np.repeat(np.arange(len(before) - 1), np.diff(before))


def repeated(hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every item: does its hash occur more than once for its owner; did it occur before."""
    with np.errstate(over="ignore"):
        key = hashes ^ mix(owner.astype(U) + U(1))
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    same = ranked[1:] == ranked[:-1]
    again, twice = np.zeros(len(key), dtype=bool), np.zeros(len(key), dtype=bool)
    again[order[1:]] = same
    twice[order[1:]] = same
    twice[order[:-1]] |= same
    return twice, again


def blocks(texts: pa.Array, limit: int = BLOCK) -> Iterator[tuple[int, int, pa.Array, np.ndarray, np.ndarray]]:
    """Rows from, rows to, those texts, their bytes and offsets. Null counts as empty."""
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64, count=len(texts) + 1 + texts.offset)[texts.offset:]
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)
    low = 0
    while low < len(texts):
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + limit, "right")) - 1)
        high = min(high, len(texts))
        yield low, high, texts.slice(low, high - low), data[offsets[low]:offsets[high]], offsets[low:high + 1] - offsets[low]
        low = high


def annotate(
    df: DataFrame, function: Callable[[pa.Array, np.ndarray, np.ndarray], dict], fields: str, text: str = "text",
    keep: list[str] | None = None, limit: int = BLOCK,
) -> DataFrame:
    """The rows with new columns that ``function(texts, data, offsets)`` computes for a block of about ``limit`` bytes.

    ``keep`` names the columns to carry along (all by default). A new column replaces one of the
    same name, whatever its case. A column ``text`` that is no string is read as one.
    """
    new = T.StructType.fromDDL(fields)
    taken = {f.name.lower() for f in new.fields}
    kept = [f for f in df.schema.fields if (keep is None or f.name in keep) and f.name.lower() not in taken]
    source = df.select(*(F.col(f"`{f.name}`") for f in kept), F.col(f"`{text}`").cast("string").alias("__text"))
    names = [f.name for f in kept] + [f.name for f in new.fields]

    def run(batches):
        for batch in batches:
            for low, high, texts, data, offsets in blocks(batch.column(batch.num_columns - 1), limit):
                made = function(texts, data, offsets)
                carried = [batch.column(i).slice(low, high - low) for i in range(len(kept))]
                yield pa.RecordBatch.from_arrays(carried + [pa.array(made[f.name]) for f in new.fields], names=names)

    return source.mapInArrow(run, T.StructType(kept + new.fields))


def texts_only(df: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Just the identifier and the text, under their own names."""
    return df.select(F.col(f"`{id_column}`").alias(id_column), F.col(f"`{text}`").cast("string").alias(text))


def fold(id_column: str, folds: int):
    """crc32 of the identifier as text, modulo ``folds``; a null identifier counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")), F.lit(folds))
