import types
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from shelfcast.llm import bpe, packing, wordpieces

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")

TEXTS = [
    "", " ", "a", "  a  b\n\n c", "x \n y", "<|endoftext|>", "a<|endoftext|> b  <|endoftext|>", "\x1c a\x1c b", "don't I'll 'S we've",
    "　a　b  c", "é é 日本語 🎉🎉 x", "\t\ta b\r\n", "x" * 300 + "y" * 50, "1234 5,6 ...!!! \r\n\r\n z", "\0\0a \0b", "aaaa " * 50,
]


@pytest.fixture(scope="module")
def byte_library():
    return Tokenizer.from_file(BYTE)


def test_encode_equals_library(byte_library):
    known = bpe.Vocabulary(BYTE)
    for text, got in zip(TEXTS, known.encode(TEXTS)):
        ids = byte_library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(got, "<u4").tolist() == ids
        assert known.decode(got) == byte_library.decode(ids, skip_special_tokens=False)


def test_long_word_heap_equals_short_scan():
    known = bpe.Vocabulary(BYTE)
    words = [("abcdefgh" * 6)[:n].encode() for n in range(2, bpe.SHORT + 1)]
    assert [known.merge_long(w) for w in words] == [known.merge([w])[w] for w in words]


def test_round_trip_edges(edge_docs, no_docs, byte_library):
    got = bpe.round_trip(edge_docs, BYTE).collect()
    assert len(got) == 9
    for row in got:
        assert row["decoded"] == (row["text"] or "")
        assert np.frombuffer(row["ids"], "<u4").tolist() == byte_library.encode(row["text"] or "", add_special_tokens=False).ids
    assert {row["Score"] for row in got} == {"a", "b", None, "c", "d", "e", "f"}
    coded = bpe.encode(edge_docs, BYTE, keep=["doc_id"])
    assert coded.columns == ["doc_id", "ids"] and bpe.decode(coded, BYTE).where("decoded is null").count() == 0
    assert bpe.round_trip(no_docs, BYTE).count() == 0


def test_word_ids_equal_library():
    library, known = Tokenizer.from_file(WORD), packing.WordIds(WORD)
    texts = [*TEXTS, "<|ENDOFTEXT|> A <|startoftext|>B", "École It's ÉCOLE"]
    for text, got in zip(texts, known.encode([t.encode() for t in texts])):
        assert np.frombuffer(got, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_pack_places_every_id_once(edge_docs, no_docs):
    library = Tokenizer.from_file(WORD)
    placed = packing.pack(edge_docs, WORD).toPandas()
    texts = {r["doc_id"]: r["text"] or "" for r in edge_docs.where("doc_id is not null").collect()}
    for doc, text in texts.items():
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, 2], "<u4")
        rows = placed[placed.doc_id == doc].sort_values("start")
        if doc == 5:
            assert len(rows) == 2 and rows.sequence_id.nunique() + rows.offset.nunique() > 2
            continue
        at = 0
        for row in rows.itertuples():
            assert row.start == at and row.length <= 4096 and row.doc_tokens == len(ids)
            assert row.ids_crc32 == zlib.crc32(ids[at:at + row.length].tobytes())
            at += row.length
        assert at == len(ids)
    for _, rows in placed.groupby("sequence_id"):
        rows = rows.sort_values("offset")
        assert rows.offset.tolist() == [0, *rows.length.cumsum().tolist()[:-1]] and rows.length.sum() <= 4096
    assert packing.pack(no_docs, WORD).count() == 0


def test_best_fit_is_the_tightest():
    rng = np.random.default_rng(1)
    lengths = sorted(rng.integers(1, 65, 500).tolist(), reverse=True)
    windows, offsets = packing.best_fit(lengths, 64)
    room: list[int] = []
    for length, window, offset in zip(lengths, windows, offsets):
        fits = [r for r in room if r >= length]
        if fits:
            assert room[window] == min(fits) and offset == 64 - room[window]
            room[window] -= length
        else:
            assert window == len(room) and offset == 0
            room.append(64 - length)


def test_sequences_hold_the_ids(edge_docs):
    docs = edge_docs.where("doc_id in (1, 6, 8)")
    placed, cut = packing.pack(docs, WORD), packing.pieces(docs, WORD)
    rows = packing.sequences(placed, cut).toPandas()
    held = placed.toPandas()
    assert rows.n_tokens.sum() == held.length.sum()
    first = held.sort_values("length").iloc[-1]
    ids = np.frombuffer(rows[rows.sequence_id == first.sequence_id].ids.iloc[0], "<u4")
    assert zlib.crc32(ids[first.offset:first.offset + first.length].tobytes()) == first.ids_crc32


def test_pieces_encode_runs_not_words(spark, monkeypatch):
    asked = []
    tables = wordpieces.RunIds(WORD)
    learn = tables.learn_runs
    monkeypatch.setattr(tables, "learn_runs", lambda runs: (asked.extend(runs), learn(runs)))
    monkeypatch.setattr(packing, "run_ids", lambda path: tables)
    texts = [*TEXTS, "<|ENDOFTEXT|> A <|startoftext|>B", "École It's ÉCOLE", "red-blue green-blue", "red-green blue-red"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    batch = docs.coalesce(1).toArrow().to_batches()
    source = types.SimpleNamespace(schema=docs.schema, mapInArrow=lambda run, fields: run)
    monkeypatch.setattr(packing, "texts_only", lambda *a: source)
    library, got = Tokenizer.from_file(WORD), {}
    for made in packing.pieces(docs, WORD)(batch):
        got.update(zip(made.column(0).to_pylist(), made.column(3).to_pylist()))
    for k, text in enumerate(texts):
        assert np.frombuffer(got[k], "<u4").tolist() == [*library.encode(text, add_special_tokens=False).ids, packing.END_ID]
    assert asked.count("red") == asked.count("blue") == 1 and "red-blue" not in asked


def test_tables_of_runs_stay_small():
    """A worker keeps its tables while it does other work."""
    ids = wordpieces.RunIds(public_tokenizers.path("word_bpe_49k.json"))
    letters = np.array(list("bcdfghklmnprstvz"))
    for k in range(14):
        codes = np.arange(k * 50_000, (k + 1) * 50_000)
        runs = ["".join(x) for x in letters[(codes[:, None] >> np.arange(0, 20, 4)) & 15]]
        ids.encode([" ".join(runs).encode()])
    assert 50_000 <= len(ids.runs) + len(ids.runs_before) <= 2 * ((1 << 18) + 50_000)
