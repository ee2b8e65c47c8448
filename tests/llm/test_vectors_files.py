"""Vector codes, whitening and token files against plain versions of their definitions."""

import hashlib
import math
import zlib
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pytest
from pyarrow import fs
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfcast.llm import codes, packing, queries, tokenfile, whitening, wordpieces

WORD = public_tokenizers.path("word_bpe_49k.json")


def kept_rows(rows, scale, shift=0):
    """(id, label, whole numbers) of the valid rows."""
    out = []
    for key, vector, label in rows:
        if vector is not None and all(c is not None and math.isfinite(c) for c in vector):
            out.append((key, label, [math.floor(scale * c) + shift for c in vector]))
    return out


def plain_codes(rows, parts=8, entries=16, rounds=6):
    """Every part against every entry, in Python's whole numbers."""
    rows = sorted(kept_rows(rows, 4096), key=lambda r: (r[0] is None, r[0] if r[0] is not None else 0, r[2]))
    width = len(rows[0][2]) // parts
    cut = [[r[2][p * width:(p + 1) * width] for p in range(parts)] for r in rows]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def nearest(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, entry)), k) for k, entry in enumerate(book))

    for _ in range(rounds):
        own = [[nearest(c[p], books[p])[1] for p in range(parts)] for c in cut]
        for p in range(parts):
            for k in range(len(books[p])):
                members = [c[p] for c, o in zip(cut, own) if o[p] == k]
                if members:
                    books[p][k] = [sum(column) // len(members) for column in zip(*members)]
    last = [[nearest(c[p], books[p]) for p in range(parts)] for c in cut]
    errors = [sum(d for d, _ in row) for row in last]
    by_label = {}
    for r, e in zip(rows, errors):
        by_label[r[1]] = by_label.get(r[1], 0) + e
    digest = hashlib.sha256(",".join(str(v) for book in books for entry in book for v in entry).encode()).hexdigest()
    return sorted((str(r[0]), "".join(f"{k:02x}" for _, k in row), e, by_label[r[1]], digest) for r, row, e in zip(rows, last, errors))


def op11_rows(spark, rows, **more):
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").withColumns({"x": F.lit("clash"), "ID": F.lit(1)})
    coded, books = codes.compress(df.repartition(3), **more)
    found = codes.with_group_error(coded).collect()
    return sorted((str(r["id"]), bytes(r["codes"]).hex(), r["error"], r["label_error"], codes.digest(books)) for r in found)


def random_vectors(seed, n, width, centres=5, spread=0.05):
    rng = np.random.default_rng(seed)
    middle = rng.standard_normal((centres, width))
    return [(int(k), (middle[rng.integers(centres)] + spread * rng.standard_normal(width)).tolist(), int(rng.integers(3)) if k % 7 else None)
            for k in range(n)]


@pytest.mark.parametrize("spread", [0.0, 0.05, 1.0])
def test_codes_equal_every_entry_compared(spark, spread):
    rows = random_vectors(3, 300, 16, spread=spread)
    rows += [(1000, None, 1), (1001, [math.nan] * 16, 1), (1002, [None] + [0.0] * 15, 1), (1003, [math.inf] * 16, None), (7, rows[7][1], 2),
             (None, rows[8][1], 1), *[(2000 + k, rows[9][1], 0) for k in range(150)]]
    assert op11_rows(spark, rows) == plain_codes(rows)


def test_codes_ties_and_fewer_rows_than_entries(spark):
    rows = [(k, [float(v % 3 - 1) / 4096 for v in range(k, k + 16)], None) for k in range(9)]
    assert op11_rows(spark, rows) == plain_codes(rows)
    assert op11_rows(spark, rows[:1]) == plain_codes(rows[:1])


def test_codes_uneven_lengths_and_nothing(spark):
    rows = [(1, [1.0, 2.0, 3.0], 1), (2, [1.0] * 9, 1), (3, [], None), (4, [1e30] * 9, 1)]
    found = op11_rows(spark, rows)
    assert [r[0] for r in found] == ["1", "2", "3", "4"] and all(len(r[1]) == 16 for r in found)
    filled = [(k, (v + [0.0] * 16)[:16], label) for k, v, label in rows[:3]]
    assert op11_rows(spark, rows[:3]) == plain_codes(filled)
    assert op11_rows(spark, [(1, None, 1)]) == [] and [r[1:4] for r in op11_rows(spark, [(1, [], 1)])] == [("00" * 8, 0, 0)]


def test_settled_balls_do_no_work():
    centres = np.array([[0, 0], [100, 0], [0, 1000]])
    balls = codes.Balls.around(centres, np.array([10.0, 10.0, 10.0]), np.zeros(3, dtype=bool))
    assert balls.settled.all() and balls.near == [[], [], []]
    assert codes.Balls.around(centres, np.array([60.0, 10.0, 10.0]), np.array([False, True, False])).near == [[1], [], []]
    far = np.array([[52, 0], [10, 0], [50, 0]])
    assert codes.Balls.around(centres, np.array([60.0, 0, 0]), np.ones(3, dtype=bool)).assign(far, np.zeros(3, dtype=np.uint8)).tolist() == [1, 0, 0]


def test_decoded_codes_are_entries(spark):
    df = spark.createDataFrame(random_vectors(5, 60, 16), "vec_id bigint, embedding array<double>, label int")
    coded, books = codes.compress(df)
    found = codes.decoded(coded, books).join(df.withColumnRenamed("vec_id", "id"), "id").collect()
    for r in found:
        assert sum((a - math.floor(4096 * b)) ** 2 for a, b in zip(r["x"], r["embedding"])) == r["error"]


def test_registered_codes_on_given_vectors(spark, sf_dir):
    given = [(r["vec_id"], r["embedding"], r["label"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    found = queries.QUERIES["op11_codes"](spark, sf_dir).collect()
    assert sorted((str(r["vec_id"]), r["code"], r["error"], r["label_error"], r["codebooks_sha256"]) for r in found) == plain_codes(given)


def check_whitening(rows, found, components=16):
    kept = kept_rows(rows, 64, 1_000_000)
    distinct = sorted(set(tuple(r[2]) for r in kept))
    n, sums = len(distinct), [sum(c) for c in zip(*distinct)]
    centred = np.array([[float(n * v - s) / n for v, s in zip(x, sums)] for x in distinct])
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    wanted = min(components, len(values), int((values > 1e-13 * values[0]).sum()))
    assert len(found) == wanted * len(kept)
    by_key = {}
    for r in found:
        by_key.setdefault((r["id"], r["component"]), []).append(r)
    signs = {}
    for key, _, x in kept:
        white = np.array([float(n * v - s) / n for v, s in zip(x, sums)]) @ vectors[:, :wanted] / np.sqrt(values[:wanted])
        deviation = sum((n * v - s) ** 2 for v, s in zip(x, sums))
        for c in range(wanted):
            r = by_key[key, c + 1][0]
            assert (r["n"], r["deviation"]) == (n, deviation) and r["identity_error"] <= 1e-8
            assert abs(r["explained"] - values[c] / values.sum()) <= 1e-9 * r["explained"]
            if abs(white[c]) > 1e-6:
                signs.setdefault(c, np.sign(white[c] * r["whitened"]))
            assert abs(abs(white[c]) - abs(r["whitened"])) < 1e-6 and white[c] * r["whitened"] * signs.get(c, 1) > -1e-9


def test_whitening_equals_full_eigenvectors(spark):
    rng = np.random.default_rng(2)
    scales = np.linspace(3, 0.5, 40)
    rows = [(int(k), (rng.standard_normal(40) * scales).tolist(), 1) for k in range(500)]
    rows += [(900, None, 1), (901, [math.nan] * 40, 1), (902, [None] * 40, 1), *[(1000 + k, rows[3][1], 1) for k in range(100)], (None, rows[4][1], 2)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, x int").withColumn("N", F.lit(1))
    found = whitening.whiten(df.repartition(4)).collect()
    check_whitening(rows, found)
    assert found[0]["passes"] > 2 and found[0]["residual"] < 1e-10


def test_whitening_edges(spark):
    def run(rows):
        return whitening.whiten(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")).collect()

    assert run([(1, None, 1)]) == [] and run([(1, [1.0, 2.0], 1), (2, [1.0, 2.0], 1)]) == [] and run([(1, [], 1), (2, [], 1)]) == []
    rows = [(1, [1.0, 0.0, 5.0], 1), (2, [2.0, 1.0, 5.0], 1), (3, [4.0, -1.0, 5.0], 1)]
    check_whitening(rows, run(rows))
    far = run([(1, [1e30, 0.0], 1), (2, [0.0], 1), (3, [1.0, 1.0], 1)])
    assert {r["id"] for r in far} == {1, 2, 3}


def test_exact_deviations():
    x = np.array([[10**6, 10**6 + 5], [1 << 31, -(1 << 31)], [3, 4]], dtype=np.int64)
    for n, sums in ((3, [3 * 10**6 + 1, 7]), (10**6, [10**12 + 1, 5]), (10**10, [10**16 + 3, 10**16])):
        want = [sum((n * v - s) ** 2 for v, s in zip(row, sums)) for row in x.tolist()]
        assert whitening._deviations(x, n, sums) == [w if w < 1 << 63 else None for w in want]


def test_registered_whitening_on_given_vectors(spark, sf_dir):
    given = [(r["vec_id"], r["embedding"], r["label"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    check_whitening(given, queries.QUERIES["op12_whitening"](spark, sf_dir).withColumnRenamed("vec_id", "id").collect())


def plain_files(rows):
    """(id, start, n_tokens, crc32) by the library, in order of identifier."""
    library, at, out = Tokenizer.from_file(WORD), 0, []
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [2], dtype="<u4")
        out.append((key, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


def test_token_files_on_given_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = queries.QUERIES["op13_tokenfile"](spark, sf_dir).collect()
    assert sorted(map(tuple, found)) == sorted(plain_files([(r["doc_id"], r["text"]) for r in docs.collect()]))


def test_token_files_edges(spark, edge_docs, no_docs, tmp_path):
    folder = tokenfile.write(edge_docs, WORD, folder=f"file://{tmp_path}/files", part_bytes=1000)
    found = tokenfile.read(spark, folder).withColumn("crc", F.crc32("ids")).drop("ids").collect()
    assert sorted(map(tuple, found), key=lambda r: r[1]) == plain_files([(r["doc_id"], r["text"]) for r in edge_docs.collect()])
    manifest = spark.read.parquet(f"{folder}/manifest").orderBy("part").collect()
    assert len(manifest) > 3 and all(r["width"] == 2 for r in manifest)
    at = 0
    for r in manifest:  # the files are gapless, flat and as long as the manifest says
        offsets = np.fromfile(f"{tmp_path}/files/offsets-{r['part']:08d}.bin", dtype="<i8")
        ids = np.fromfile(f"{tmp_path}/files/ids-{r['part']:08d}.bin", dtype="<u2")
        assert r["first_id"] == at == offsets[0] and len(offsets) == r["docs"] + 1 and offsets[-1] - at == len(ids) == r["ids"]
        at += len(ids)
    assert tokenfile.read(spark, tokenfile.write(no_docs, WORD)).count() == 0


def test_token_files_spread_copies_and_other_identifiers(spark):
    copies = spark.range(400).select(F.lit("same").alias("doc_id"), F.lit("one two three").alias("text"))
    folder = tokenfile.write(copies.union(spark.createDataFrame([("a", "x"), (None, None)], "doc_id string, text string")), WORD)
    manifest = spark.read.parquet(f"{folder}/manifest").collect()
    assert len(manifest) > 4 and max(r["docs"] for r in manifest) < 200
    found = tokenfile.read(spark, folder).orderBy("start").collect()
    assert [r["doc_id"] for r in found[:2]] == [None, "a"] and len(found) == 402
    assert [r["start"] for r in found[1:]] == np.cumsum([r["n_tokens"] for r in found])[:-1].tolist()


def test_wide_ids_and_ranges_read(tmp_path, monkeypatch):
    with tokenfile.output(str(tmp_path), "some.bin") as file:
        file.write(np.arange(100, dtype="<u4").tobytes())
    assert tokenfile.Flat(str(tmp_path), "some.bin", "<u4")[3:6].tolist() == [3, 4, 5]
    monkeypatch.setattr(tokenfile, "mounted", lambda folder: None)
    store = SimpleNamespace(from_uri=lambda uri: (fs.LocalFileSystem(), str(tmp_path)))
    monkeypatch.setattr(tokenfile, "fs", SimpleNamespace(FileSystem=store))
    assert tokenfile.Flat("store://x", "some.bin", "<u4")[3:6].tolist() == [3, 4, 5]
    with tokenfile.output("store://x", "other.bin") as file:
        file.write(b"abcd")
    assert (tmp_path / "other.bin").read_bytes() == b"abcd"


def test_runs_equal_whole_words():
    known, runs = packing.WordIds(WORD), wordpieces.RunIds(WORD)
    texts = ["don't 'table' it's o'clock a'sb", "x-y z... 12½ ß straße ÉCOLE İx", "á éx <|endoftext|>a ­ b", "x\x1cy 日本語x ﬁne \U0001f389!", "###a&&&b's'"]
    coded = [t.encode() for t in texts] * 2
    assert runs.known and runs.encode(coded) == known.encode(coded)
    library = Tokenizer.from_file(WORD)
    assert [np.frombuffer(i, "<u4").tolist() for i in runs.encode(coded[:5])] == [library.encode(t, add_special_tokens=False).ids for t in texts]
