"""Ids of texts from tables of what was encoded before: of whole words, and of runs of letters, digits and
marks as the tokenizer's pattern cuts them."""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import regex

# The tokenizer file's own pattern of what it encodes apart.
RUNS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
LAST = "</w>"
TOGETHER = 64
BEYOND = 0x250   # characters below it, without the controls, change by lower case only
CAREFUL = "İ\x85\xa0"  # but for these
CACHED = 1 << 18  # entries; a worker keeps up to twice as many while it does other work


class WordIds:
    """Ids of whole words from a tokenizer file that drops white space, each word encoded once."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.words: dict[bytes, bytes] = {}
        self.earlier: dict[bytes, bytes] = {}
        lowers = self.tokenizer.normalizer is not None and self.tokenizer.normalizer.normalize_str("A") == "a"
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()] if lowers else None

    def learn(self, words: list[bytes]) -> None:
        for at in range(0, len(words), 20_000):
            part = words[at:at + 20_000]
            coded = self.tokenizer.encode([w.decode() for w in part], is_pretokenized=True, add_special_tokens=False)
            ids, owner = np.array(coded.ids, dtype="<u4"), np.array(coded.word_ids, dtype=np.int64)
            bounds = (4 * np.searchsorted(owner, np.arange(len(part) + 1))).tolist()
            flat = ids.tobytes()
            self.words.update((w, flat[bounds[k]:bounds[k + 1]]) for k, w in enumerate(part))

    def fold(self, text: bytes) -> bytes:
        """The text in lower case where the tokenizer makes no difference: it lowers letters
        itself, but finds its special tokens before that."""
        if self.special is None:
            return text
        low = text.lower()
        return text if any(s in low for s in self.special) else low

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of every text as little-endian unsigned 32-bit integers. A tokenizer that drops
        white space gives a text the ids of its words in order, so only unknown words cost."""
        if len(self.words) > CACHED:
            self.words, self.earlier = {}, self.words
        split = [self.fold(t).split() for t in texts]
        missing = set().union(*split).difference(self.words)
        known = missing.intersection(self.earlier)
        self.words.update((w, self.earlier[w]) for w in known)
        missing -= known
        if missing:
            self.learn(list(missing))
        get = self.words.__getitem__
        return [b"".join(map(get, words)) for words in split]


class RunIds(WordIds):
    """Ids of texts from ids of their runs, which the library encodes in short sentences; ids that
    close a run tell where it ends. Texts with other characters or special tokens go through whole
    words, and so do all texts if the file's pattern is not the one above."""

    def __init__(self, path: str):
        super().__init__(path)
        vocabulary = self.tokenizer.get_vocab()
        self.closing = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.closing[[i for token, i in vocabulary.items() if token.endswith(LAST)]] = True
        self.known = self.special is not None and RUNS in str(self.tokenizer.pre_tokenizer)
        low = [chr(c) for c in (*range(33, 127), *range(161, BEYOND)) if chr(c) not in CAREFUL]
        letters = re.escape("".join(c for c in low if regex.fullmatch(r"\p{L}", c)))
        digits = re.escape("".join(c for c in low if regex.fullmatch(r"\p{N}", c)))
        # What a run starts with tells its kind, so letters can be tried first.
        self.find = re.compile(rf"[{letters}]+|[{digits}]|'(?:s|t|re|ve|m|ll|d)|[^\s{letters}{digits}]+").findall
        self.plain = re.compile(f"[ \t-\r{re.escape(''.join(low))}]*").fullmatch
        self.runs: dict[str, bytes] = {}
        self.runs_before: dict[str, bytes] = {}

    def encode(self, texts: list[bytes]) -> list[bytes]:
        if len(self.runs) > CACHED:
            self.runs, self.runs_before = {}, self.runs
        cut: list[list[str] | None] = []
        for text in texts:
            low = text.decode().lower() if self.known else ""
            cut.append(self.find(low) if self.known and self.plain(low) and "<|" not in low else None)
        missing = set().union(*filter(None, cut)).difference(self.runs)
        again = missing.intersection(self.runs_before)
        self.runs.update((run, self.runs_before[run]) for run in again)
        self.learn_runs(list(missing - again))
        get, out, others = self.runs.__getitem__, [], []
        for k, runs in enumerate(cut):
            try:
                out.append(b"" if runs is None else b"".join(map(get, runs)))
            except KeyError:
                runs = None
                out.append(b"")
            if runs is None:
                others.append(k)
        for k, ids in zip(others, super().encode([texts[k] for k in others])):
            out[k] = ids
        return out

    def learn_runs(self, runs: list[str]) -> None:
        """Runs in sentences of 64, each of which gives one closing id per run. Others stay unknown."""
        parts = [runs[k:k + TOGETHER] for k in range(0, len(runs), TOGETHER)]
        for part, coded in zip(parts, self.tokenizer.encode_batch_fast([" ".join(p) for p in parts], add_special_tokens=False)):
            ids = np.array(coded.ids, dtype="<u4")
            ends = (4 * (np.flatnonzero(self.closing[ids]) + 1)).tolist()
            if len(ends) == len(part):
                flat = ids.tobytes()
                self.runs.update((run, flat[a:b]) for run, a, b in zip(part, [0, *ends], ends))


@lru_cache(maxsize=2)
def run_ids(path: str) -> RunIds:
    return RunIds(path)
