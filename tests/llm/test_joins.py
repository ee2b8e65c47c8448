import collections
import inspect
import itertools
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.llm import components, linededup, neighbours, parity
from tests.llm.conftest import words

WORD = re.compile("[^\x20\x09-\x0d]+")


class Sets:
    """Union-find on one machine."""

    def __init__(self):
        self.above = {}

    def find(self, x):
        while self.above.setdefault(x, x) != x:
            x = self.above[x]
        return x

    def join(self, x, y):
        x, y = self.find(x), self.find(y)
        self.above[max(x, y)] = min(x, y)


def test_components_equal_union_find(spark):
    rng = random.Random(1)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(400, 440)] + [(500, k) for k in range(501, 560)]
    links += [(7, 7), (None, 3), links[0]]
    sets = Sets()
    for a, b in links:
        if a is not None and a != b:
            sets.join(a, b)
    got = components.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    assert {r["node"]: r["component"] for r in got} == {x: sets.find(x) for x in sets.above} and len(got) == len(sets.above)
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def edited(rng, made, n):
    out = list(made)
    for _ in range(n):
        out[rng.randrange(len(out))] = words(rng, 1)[0]
    return out


def near_copies(seed=0, groups=14):
    rng, docs = random.Random(seed), {}
    for g in range(groups):
        base = words(rng, rng.choice([2, 8, 40, 120, 300]))
        for k in range(rng.randint(1, 9)):
            docs[len(docs)] = " ".join(edited(rng, base, rng.choice([0, 0, 1, 2, 5])))
    base = words(rng, 200)  # a chain: neighbours link, the ends do not
    for k in range(12):
        base = edited(rng, base, 2)
        docs[len(docs)] = " ".join(base)
    return docs


def brute_components(docs, width, num):
    sets, links = {}, Sets()
    for d, t in docs.items():
        found = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in WORD.findall(t or "")]
        sets[d] = {tuple(found[k:k + width]) for k in range(len(found) - width + 1)} or ({tuple(found)} if found else set())
    for a, b in itertools.combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= num * len(sets[a] | sets[b]):
            links.join(a, b)
    return {d: (len(sets[d]), links.find(d)) for d in sets}


@pytest.mark.parametrize("width, num", [(3, 90), (5, 80)])
def test_similar_equals_all_pairs(spark, monkeypatch, width, num):
    monkeypatch.setattr(parity, "SLICE", 500)
    monkeypatch.setattr(parity, "FLUSH", 300)
    docs = near_copies(width)
    docs.update({9000: docs[0].upper(), 9001: "Same words here", 9002: "same WORDS\there", 9003: "same words", 9004: "", 9005: None, 9006: " \n"})
    frame = spark.createDataFrame(list(docs.items()), "doc_id bigint, text string").repartition(4)
    got = parity.similar(frame, width, num, 100).collect()
    want = brute_components(docs, width, num)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want and len(got) == len(docs)
    assert len({c for _, c in want.values()}) < len(docs) - 20


def test_sketches_bound_the_difference():
    rng = np.random.default_rng(1)
    bands = parity.Bands(90, 100)
    for size in (1, 5, 12, 60, 400):
        a = rng.integers(0, 2**63, size).astype(np.uint64)
        spare = (100 - 90) * 2 * size // (100 + 90)
        b = np.concatenate([a[spare // 2:], rng.integers(0, 2**63, spare - spare // 2).astype(np.uint64)])
        members, before = np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)])
        apart = len(np.setxor1d(a, b))
        assert apart <= parity.bound(len(a) + len(b), 90, 100)
        keys, of_set = parity.segment_keys(members, before, bands)
        assert len(np.intersect1d(keys[:of_set[1]], keys[of_set[1]:])) > 0
        x, y = parity.bit_sketches(members, before)
        length = min(len(x), len(y))
        assert np.bitwise_count(parity.fold_sketch(x, length) ^ parity.fold_sketch(y, length)).sum() <= apart


def test_similar_edges(edge_docs, no_docs):
    got = parity.similar(edge_docs).collect()
    assert len(got) == 9
    assert {(r["doc_id"], r["component_id"]) for r in got} == {(1, 1), (2, 2), (3, 3), (None, None), (5, 5), (6, 6), (7, 7), (8, 8)}
    assert parity.similar(no_docs).count() == 0


def brute_lines(docs):
    rows = [(d, k, line.strip(" ")) for d, t in sorted(docs.items()) if t is not None for k, line in enumerate(t.split("\n"))]
    rows = [r for r in rows if len(r[2]) >= linededup.LEAST]
    grams = {line: {line[k:k + 5] for k in range(len(line) - 4)} for _, _, line in rows}
    sets = Sets()
    for a, b in itertools.combinations(grams, 2):
        both = len(grams[a] & grams[b])
        if 100 * both >= linededup.PERCENT * len(grams[a] | grams[b]):
            sets.join(a, b)
    seen, removed = set(), collections.defaultdict(set)
    for d, k, line in rows:
        if sets.find(line) in seen:
            removed[d].add(k)
        seen.add(sets.find(line))
    return removed


def test_lines_equal_all_pairs(spark):
    rng = random.Random(5)
    bases = [words(rng, 22) for _ in range(25)]
    docs = {}
    for d in range(60):
        lines = [" ".join(edited(rng, rng.choice(bases), rng.choice([0, 0, 1]))) if rng.random() < 0.5 else " ".join(words(rng, 18)) for _ in range(4)]
        docs[d] = "\n".join([*lines, "short line", ""])
    frame = spark.createDataFrame(list(docs.items()), "doc_id bigint, text string").repartition(5)
    want = brute_lines(docs)
    got = {r["doc_id"]: r for r in linededup.report(frame).collect()}
    expected, found = {(d, k) for d in want for k in want[d]}, {(d, k) for d, r in got.items() for k in r["removed"]}
    # The exact check admits nothing else; banding may miss a little.
    assert found <= expected and len(found) >= 0.97 * len(expected) > 50
    assert all(r["n_lines"] == 6 and r["n_removed"] == len(r["removed"]) for r in got.values())
    shorter = {r["doc_id"]: r["text"] for r in linededup.remove(frame).collect()}
    for d, text in docs.items():
        assert shorter[d] == "\n".join(line for k, line in enumerate(text.split("\n")) if k not in set(got[d]["removed"]))


def test_lines_fold_case(spark):
    rng = random.Random(8)
    heads = [" ".join(words(rng, 12)) for _ in range(20)]
    docs = {k: text for k, text in enumerate([*heads, *map(str.upper, heads), *map(str.title, heads)])}
    got = linededup.report(spark.createDataFrame(list(docs.items()), "doc_id bigint, text string")).collect()
    want = brute_lines({d: t.lower() for d, t in docs.items()})
    assert {r["doc_id"]: set(r["removed"]) for r in got if r["n_removed"]} == want and len(want) == 40


def test_lines_without_spaces(spark):
    rng, docs = random.Random(11), {}
    for k in range(0, 120, 2):
        line = [chr(rng.randrange(0x4E00, 0x5E00)) for _ in range(rng.randrange(50, 120))]
        docs[k] = "".join(line)
        line[rng.randrange(len(line))] = "\u3042"
        docs[k + 1] = "".join(line)
    for k, line in ((200, "0123456789"), (210, "\U0001F389\U0001F38A\U0001F38B\U0001F38C\U0001F38D\U0001F38E")):  # few distinct shingles, lengths apart
        docs[k], docs[k + 1] = line * 10, line * 30
    got = linededup.report(spark.createDataFrame(list(docs.items()), "doc_id bigint, text string")).collect()
    want = brute_lines(docs)
    assert {r["doc_id"] for r in got if r["n_removed"]} == set(want) and len(want) >= 60


def test_lines_inside_a_band(spark, monkeypatch):
    monkeypatch.setattr(linededup, "BLOCK", 7)
    one = [F.lit(k).cast("bigint").alias(f"band_{k}") for k in range(linededup.BANDS)]
    monkeypatch.setattr(linededup, "bands", lambda lines: lines.drop("line").select("*", *one))  # all lines share all bands
    rng, docs = random.Random(21), {}
    for _ in range(25):
        base = words(rng, 24)
        for _ in range(rng.choice([1, 2, 2, 3])):
            docs[len(docs)] = " ".join(edited(rng, base, 1))
    got = linededup.report(spark.createDataFrame(list(docs.items()), "doc_id bigint, text string").repartition(3)).collect()
    want = brute_lines(docs)
    assert {r["doc_id"] for r in got if r["n_removed"]} == set(want) and len(want) > 10


def test_line_plan_has_no_python(spark, edge_docs):
    plan = linededup.remove(edge_docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_line_edges(edge_docs, no_docs):
    got = linededup.remove(edge_docs)
    assert got.columns == edge_docs.columns
    rows = {(r["doc_id"], r["Score"]): r for r in got.collect()}
    assert got.count() == 9 and rows[(2, "b")]["text"] is None and rows[(3, None)]["text"] == ""
    before = {(r["doc_id"], r["Score"]): r["text"] for r in edge_docs.collect()}
    assert {k: r["text"] for k, r in rows.items()} == before
    assert linededup.remove(no_docs).count() == 0
    copies = edge_docs.where("doc_id = 1").unionByName(edge_docs.where("doc_id = 1").selectExpr("2L as doc_id", "text", "Score", "ids", "n_words"))
    assert {r["doc_id"]: r["text"].strip() for r in linededup.remove(copies).collect()}[2] == ""


def brute_nearest(rows, asked, count):
    out = {}
    known = [(i, np.array(v, dtype=float) / max(map(abs, v))) for i, v in rows if v is not None and len(v) == 8 and None not in v and np.isfinite(v).all() and any(v)]
    for i, v in known:
        if asked(i):
            scored = sorted((-(w @ v) / (np.linalg.norm(v) * np.linalg.norm(w)), j) for j, w in known if j != i)[:count]
            out[i] = [(j, -s) for s, j in scored]
    return out


def test_neighbours_equal_brute_force(spark):
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(12, 8))
    rows = [(k, (centres[k % 12] + rng.normal(size=8) * 0.3).tolist()) for k in range(600)]
    rows += [(1000 + k, rows[50][1]) for k in range(40)] + [(2000, None), (2050, [0.0] * 8), (2100, [float("nan")] * 8), (2150, [None] + [1.0] * 7),
                                                          (2200, [1.0] * 5), (2250, [float("inf")] + [0.0] * 7), (2300, [1e-200] * 8)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(4)
    got = collections.defaultdict(list)
    for r in neighbours.search(frame, frame.vec_id % 50 == 0, part=64, sample=200).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["id"], r["score"], r["rank"]))
    want = brute_nearest(rows, lambda i: i % 50 == 0, 5)
    assert set(got) == set(want) and all([rank for *_, rank in v] == [1, 2, 3, 4, 5] for v in got.values())
    hits = sum(len({j for j, *_ in got[q]} & {j for j, _ in want[q]}) for q in want)
    assert hits >= 0.95 * 5 * len(want)
    assert [j for j, *_ in got[1000]] == [50, 1001, 1002, 1003, 1004]
    exact = {q: dict(v) for q, v in want.items()}
    assert all(abs(s - exact[q][j]) < 1e-9 for q in got for j, s, _ in got[q] if j in exact[q])


def test_neighbours_stop_late_enough():
    assert inspect.signature(neighbours.search).parameters["sure"].default >= 0.985  # each true neighbour's loss is 1.5 % at most


def test_neighbours_edges(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 2.0]), (50, [1.0, 1.0])], "vec_id bigint, embedding array<float>")
    got = neighbours.search(few, few.vec_id % 50 == 0).orderBy("query_id", "rank").collect()
    assert [(r["query_id"], r["id"], r["rank"]) for r in got] == [(0, 50, 1), (0, 1, 2), (50, 0, 1), (50, 1, 2)]
    none = few.where("false")
    assert neighbours.search(none, none.vec_id % 50 == 0).count() == 0


def test_chi_square():
    assert abs(neighbours.chi_square_above(15.507, 8) - 0.05) < 1e-4
    assert abs(neighbours.chi_square_limit(0.05, 8) - 15.507) < 1e-2


def test_remove_from_a_document_of_very_many_lines(spark):
    """Every line stands twice; each is split off once, so many lines take little longer."""
    lines = [f"line number {k} tells something of its own, {k * 7919 % 10007}" for k in range(6000)]
    docs = spark.createDataFrame([(1, "\n".join(lines + lines))], "doc_id bigint, text string")
    lost = spark.createDataFrame([(1, "\n".join(lines + lines), list(range(6000, 12000)))], "doc_id bigint, text string, removed array<int>")
    known = lost.select(F.xxhash64("doc_id", "text").alias("document"), "removed")
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(linededup, "removals", lambda *a: known)
        start = time.time()
        assert linededup.remove(docs).first()["text"] == "\n".join(lines)
        assert time.time() - start < 20


def test_unlike_texts_of_one_id(spark, make_text):
    """Links of any text of an id count for the id; without repeats only copies go."""
    a, b, c = make_text(31, 200), make_text(32, 200), make_text(33, 200)
    rows = [(1, a), (1, b), (2, a + " more"), (3, b + " more"), (4, c), (4, c), (5, ""), (5, a), (None, a), (6, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = {(r["doc_id"], r["component_id"]) for r in parity.similar(docs).collect()}
    assert got == {(1, 1), (2, 1), (3, 1), (4, 4), (5, 5), (5, 1), (None, None), (6, 6)}
    left = sorted((r["doc_id"] or 0, r["text"]) for r in parity.one_of_each(docs).collect())
    assert left == sorted([(1, a), (1, b), (4, c), (5, ""), (0, a), (6, "")])


def test_one_large_key_is_dealt_in_blocks(spark, monkeypatch):
    """Sets of one key: pairs of different components, whatever the blocks, and each only once."""
    rng = np.random.default_rng(5)
    sets = [rng.integers(0, 2**63, 60).astype(np.uint64) for _ in range(30)]
    sets += [np.concatenate([s[1:], rng.integers(0, 2**63, 1).astype(np.uint64)]) for s in sets]
    before = np.arange(len(sets) + 1) * 60
    made = parity.bit_sketches(np.concatenate(sets), before)
    known = spark.createDataFrame([(7, k, 0 if k % 30 < 8 else k) for k in range(60)], "key bigint, node bigint, component bigint")
    sketches = spark.createDataFrame([(k, 60, bytearray(s)) for k, s in enumerate(made)], "node bigint, n bigint, sketch binary")
    for block in (512, 7):
        monkeypatch.setattr(parity, "BLOCK", block)
        got = [(r["a"], r["b"]) for r in parity.across(known, sketches, 90, 100).collect()]
        assert len(got) == len(set(got)) and {(k, k + 30) for k in range(8, 30)} <= set(got) and all(a < b for a, b in got)
        assert all((a if a % 30 >= 8 else 0) != (b if b % 30 >= 8 else 0) for a, b in got)


def test_neighbours_by_row(spark):
    """A query leaves out its own row alone; rows of one id are queries and candidates of their own."""
    rows = [(50, [1.0, 0.0]), (50, [0.995, 0.1]), (1, [0.0, 1.0]), (2, [1.0, 0.3]), (2, [1.0, 0.3])]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = collections.defaultdict(list)
    for r in neighbours.search(table, F.col("vec_id") % 50 == 0, count=3).collect():
        got[r["query_id"], r["rank"]].append((r["id"], round(r["score"], 6)))
    want = collections.defaultdict(list)
    for k, (query, x) in enumerate(rows):
        if query % 50 == 0:
            near = sorted((-round(float(np.dot(x, y) / np.linalg.norm(x) / np.linalg.norm(y)), 6), i) for j, (i, y) in enumerate(rows) if j != k)
            for rank, (score, i) in enumerate(near[:3], 1):
                want[query, rank].append((i, -score))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}


def test_neighbours_of_repeated_queries(spark):
    """Repeated rows of one id are each other's nearest."""
    table = spark.createDataFrame([(50, [1.0, 0.0]), (50, [1.0, 0.0]), (3, [1.0, 1.0])], "vec_id bigint, embedding array<double>")
    got = sorted((r["query_id"], r["rank"], r["id"]) for r in neighbours.search(table, F.col("vec_id") == 50, count=5).collect())
    assert got == [(50, 1, 50)] * 2 + [(50, 2, 3)] * 2


def test_nodes_of_a_slice_are_handed_on_as_steps(spark):
    for nodes in ([5], [7, 7, 7], [1, 3, 260, 1 << 40], [-(1 << 63), -3, 0, (1 << 63) - 1]):
        first, width, steps = parity.packed_nodes(np.array(nodes, dtype=np.int64))
        assert parity.unpacked_nodes(first, width, steps).tolist() == nodes
    nodes = np.sort(np.random.default_rng(3).integers(0, 256410, 35000))  # a slice of one task's entries
    assert len(parity.packed_nodes(nodes)[2]) <= 2 * len(nodes)
    # Keys that several nodes have, whatever the order in which they come.
    sets = {-9: [1, 2, 3], 4: [3, 5, 8], 70000: [1, 9], 1 << 61: [9, 3, 11], 12: [13]}
    rows = [(node, np.array(keys, dtype=np.uint64).tobytes()) for node, keys in sets.items()]
    got = parity.shared_keys(spark.createDataFrame(rows, "node bigint, keys binary").repartition(2), 3).collect()
    assert sorted(tuple(r) for r in got) == sorted((k, n) for n, keys in sets.items() for k in keys if k in (1, 3, 9))


def test_keys_are_never_stored(spark, monkeypatch, make_text):
    """Tables between the steps hold no keys of sets, whatever rows repeat; keys travel without their top bytes."""
    tables, write = {}, parity.written
    monkeypatch.setattr(parity, "written", lambda df, name: tables.setdefault(name, df.columns) and write(df, name))
    a, b = make_text(41, 300), make_text(42, 300)
    docs = spark.createDataFrame([(1, a), (1, a), (2, a + " more"), (3, b), (4, b)], "doc_id bigint, text string").repartition(2)
    got = {(r["doc_id"], r["component_id"]) for r in parity.similar(docs).collect()}
    assert got == {(1, 1), (2, 1), (3, 3), (4, 3)}
    assert {"described", "sets", "shared"} <= set(tables) and not any("keys" in columns for columns in tables.values())
    sets = [(1, np.array([5, (1 << 63) + 7], dtype=np.uint64)), (1, np.array([5, (1 << 63) + 7], dtype=np.uint64)), (2, np.array([7], dtype=np.uint64))]
    rows = spark.createDataFrame([(node, keys.tobytes()) for node, keys in sets], "node bigint, keys binary").coalesce(1)
    assert sorted(tuple(r) for r in parity.shared_keys(rows, 3).collect()) == [(7, 1), (7, 2)]
    sizes = np.array([0, 1, 5, 80, 4000])
    before = np.concatenate([[0], np.cumsum(sizes)])
    members = np.random.default_rng(2).integers(0, 2**63, before[-1]).astype(np.uint64)
    bands = parity.Bands(80, 100)
    assert parity.key_counts(sizes, bands).tolist() == np.diff(parity.segment_keys(members, before, bands)[1]).tolist()
