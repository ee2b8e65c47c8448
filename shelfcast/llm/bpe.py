"""Byte-pair encoding and decoding with a public byte-level vocabulary.

Every short word keeps its part boundaries and the merge ranks of adjacent parts in contiguous
arrays: find the smallest rank, delete that boundary, refresh the two neighbouring ranks, until
no adjacent pair can merge. Many words of equal length take these steps together as rows of one
matrix. Words too long for repeated scans keep the same ranks in a heap.

A text is cut at single spaces between two visible characters, where no token can reach across.
The pieces between are encoded once and kept in a table of bounded size in the worker.

Null and empty texts give no ids and an empty decoded text. Repeated rows are encoded alike, one
row each. ``<|endoftext|>`` in a text is the special token, as the vocabulary file says.
"""

from __future__ import annotations

import gc
import heapq
import json
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from shelfcast.llm.columns import annotate

SHORT = 48
CACHED = 1 << 19
NEVER = np.int32(2**31 - 1)
# White space as the vocabulary's pattern sees it, and the pattern itself.
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WORDS = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{WHITE}\p{{L}}\p{{N}}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+"


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a byte-level vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class Vocabulary:
    """Ids, merge ranks and token bytes of one vocabulary file, with the worker's table of pieces."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        ids, letters = content["model"]["vocab"], byte_letters()
        self.special = {t["content"]: t["id"] for t in content["added_tokens"]}
        self.tokens = [b""] * (max([*ids.values(), *self.special.values()]) + 1)
        for token, i in ids.items():
            self.tokens[i] = bytes(letters[c] for c in token)
        for token, i in self.special.items():
            self.tokens[i] = token.encode()
        merges = [m if isinstance(m, list) else m.split(" ") for m in content["model"]["merges"]]
        pairs = np.array([[ids[a], ids[b], ids[a + b]] for a, b in merges], dtype=np.int64).reshape(-1, 3)
        keys = pairs[:, 0] << 32 | pairs[:, 1]
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.merged = keys[order], order.astype(np.int32), pairs[order, 2].astype(np.int32)
        self.single = np.zeros(256, dtype=np.int32)
        for letter, b in letters.items():
            self.single[b] = ids[letter]
        self.words = regex.compile(WORDS)
        self.cuts = re.compile(r"(?<=\S) (?=\S)")
        self.marks = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self.pieces: dict[str, bytes | None] = {}
        self.edges: dict[str, bytes] = {}
        self.careful = False

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and id of each merged pair; NEVER for pairs that do not merge."""
        key = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        found = self.keys[at] == key
        return np.where(found, self.ranks[at], NEVER), self.merged[at]

    def merge_short(self, words: list[bytes]) -> list[bytes]:
        """Ids, as little-endian unsigned 32-bit integers, of words of one length."""
        out = [b""] * len(words)
        parts = self.single[np.frombuffer(b"".join(words), dtype=np.uint8).reshape(len(words), -1)]
        rows = np.arange(len(words))
        ranks = self.find(parts[:, :-1], parts[:, 1:])[0]
        while True:
            length = parts.shape[1]
            best = ranks.argmin(axis=1) if length > 1 else np.zeros(len(rows), dtype=np.int64)
            going = ranks[np.arange(len(rows)), best] < NEVER if length > 1 else np.zeros(len(rows), dtype=bool)
            if not going.all():
                ended, width = parts[~going].astype("<u4").tobytes(), 4 * length
                for k, row in enumerate(rows[~going].tolist()):
                    out[row] = ended[k * width:(k + 1) * width]
                if not going.any():
                    return out
                rows, parts, ranks, best = rows[going], parts[going], ranks[going], best[going]
            here = np.arange(len(rows))
            joined = self.find(parts[here, best], parts[here, best + 1])[1]
            # Delete the boundary after the best place: what lies beyond moves up by one.
            stay = np.arange(length - 1) <= best[:, None]
            parts = np.where(stay, parts[:, :-1], parts[:, 1:])
            parts[here, best] = joined
            ranks = np.where(stay[:, :-1], ranks[:, :-1], ranks[:, 1:])
            left, right = np.flatnonzero(best > 0), np.flatnonzero(best < length - 2)
            ranks[left, best[left] - 1] = self.find(parts[left, best[left] - 1], joined[left])[0]
            ranks[right, best[right]] = self.find(joined[right], parts[right, best[right] + 1])[0]

    def merge_long(self, word: bytes) -> bytes:
        parts = self.single[np.frombuffer(word, dtype=np.uint8)].tolist()
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        first = self.find(np.array(parts[:-1]), np.array(parts[1:]))
        heap = [(r, i, parts[i], parts[i + 1], m) for i, (r, m) in enumerate(zip(first[0].tolist(), first[1].tolist())) if r < NEVER]
        heapq.heapify(heap)

        def offer(i: int) -> None:
            j = after[i]
            if i >= 0 and j < len(parts):
                rank, merged = self.find(np.array([parts[i]]), np.array([parts[j]]))
                if rank[0] < NEVER:
                    heapq.heappush(heap, (int(rank[0]), i, parts[i], parts[j], int(merged[0])))

        while heap:
            _, i, a, b, merged = heapq.heappop(heap)
            j = after[i]
            if parts[i] != a or j >= len(parts) or parts[j] != b:
                continue
            parts[i], parts[j], after[i] = merged, -1, after[j]
            if after[i] < len(parts):
                before[after[i]] = i
            if before[i] >= 0:
                offer(before[i])
            offer(i)
        return np.array([p for p in parts if p >= 0], dtype="<u4").tobytes()

    def merge(self, words: list[bytes]) -> dict[bytes, bytes]:
        found, by_length = {}, {}
        for word in words:
            by_length.setdefault(len(word), []).append(word)
        for length, group in by_length.items():
            if length > SHORT:
                found.update((w, self.merge_long(w)) for w in group)
                continue
            step = max(1, (1 << 18) // length)
            for at in range(0, len(group), step):
                found.update(zip(group[at:at + step], self.merge_short(group[at:at + step])))
        return found

    def learn(self, pieces) -> None:
        """Encode pieces not yet in the table. A piece has the space before it, unless it starts
        with NUL NUL, which marks the start of a text. None marks pieces at whose edges white
        space meets the cut, so that the text has to be cut with more care."""
        gc.disable()  # millions of small lists that hold no cycles
        try:
            split, find = {}, self.words.findall
            for p in pieces:
                if p.startswith("\0\0"):
                    split[p] = find(p[2:]) if p[2:] and not p[-1].isspace() or self.careful else None
                else:
                    split[p] = find(" " + p) if p and not p[0].isspace() and not p[-1].isspace() or self.careful else None
            words = list(set(chain.from_iterable(filter(None, split.values()))))
            coded = [w.encode() for w in words]
            merged = self.merge(coded)
            get = dict(zip(words, map(merged.__getitem__, coded))).__getitem__
            table = self.edges if self.careful else self.pieces
            for piece, found in split.items():
                table[piece] = None if found is None else b"".join(map(get, found))
        finally:
            gc.enable()

    def segment(self, text: str) -> bytes:
        """Ids of a text in which single spaces and other white space meet: it is cut only at
        single spaces between visible characters, so pieces may hold white space at their edges."""
        cut = self.cuts.split(text)
        cut[0] = "\0\0" + cut[0]
        self.careful = True
        try:
            missing = set(cut).difference(self.edges)
            if missing:
                self.learn(missing)
        finally:
            self.careful = False
        return b"".join(map(self.edges.__getitem__, cut))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of every text."""
        for table in (self.pieces, self.edges):
            if len(table) > CACHED:
                table.clear()
        parts: list[tuple[str, list[str]]] = []  # of each segment between special tokens
        plan: list[list[int | bytes]] = []
        for text in texts:
            row: list[int | bytes] = []
            for segment in self.marks.split(text) if any(s in text for s in self.special) else (text,):
                if segment in self.special:
                    row.append(np.array([self.special[segment]], dtype="<u4").tobytes())
                elif segment:
                    cut = segment.split(" ")
                    cut[0] = "\0\0" + cut[0]
                    row.append(len(parts))
                    parts.append((segment, cut))
            plan.append(row)
        missing = set().union(*(cut for _, cut in parts)).difference(self.pieces)
        if missing:
            self.learn(missing)
        get = self.pieces.__getitem__

        def ids(segment: str, cut: list[str]) -> bytes:
            try:
                return b"".join(map(get, cut))
            except TypeError:  # a None
                return self.segment(segment)

        return [b"".join([x if isinstance(x, bytes) else ids(*parts[x]) for x in row]) for row in plan]

    def decode(self, ids: bytes) -> str:
        tokens = self.tokens
        return b"".join([tokens[i] for i in np.frombuffer(ids, dtype="<u4").tolist()]).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def encode(docs: DataFrame, path: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The rows with ``ids``: the text's ids as little-endian unsigned 32-bit integers."""
    def run(texts, data, offsets):
        return {"ids": pa.array(vocabulary(path).encode(texts.to_pylist()), pa.binary())}

    return annotate(docs, run, "ids binary", text, keep)


def round_trip(docs: DataFrame, path: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The rows with ``ids`` and ``decoded``, the text that these ids stand for."""
    def run(texts, data, offsets):
        known = vocabulary(path)
        ids = known.encode(texts.to_pylist())
        return {"ids": pa.array(ids, pa.binary()), "decoded": pa.array(map(known.decode, ids), pa.string())}

    return annotate(docs, run, "ids binary, decoded string", text, keep)


def decode(rows: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """The rows with ``decoded``, from a column of ids as ``encode`` writes them; null gives null."""
    schema = rows.select(*(c for c in rows.columns if c.lower() != "decoded")).schema
    names = [*schema.names, "decoded"]

    def run(batches):
        for batch in batches:
            made = [None if x is None else vocabulary(path).decode(x) for x in batch.column(names.index(ids)).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(len(names) - 1)] + [pa.array(made, pa.string())], names=names)

    return rows.select(*schema.names).mapInArrow(run, schema.add("decoded", "string"))
