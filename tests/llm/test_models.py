import collections
import math
import random
import re
import tracemalloc

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shelfcast.llm import crf, lm, quality, rules, toxicity
from shelfcast.llm.columns import blocks, line_spans, span_hashes, word_spans
from shelfcast.llm.labelled import sample
from tests.llm.conftest import words

WORD = re.compile("[^\x20\x09-\x0d]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def test_spans_and_hashes():
    texts = ["", "a b", None, " Abc\nabc\x0bx ", "é\n\n", "b"]
    (_, _, _, data, offsets), = blocks(pa.array(texts))
    starts, ends, before = word_spans(data, offsets)
    flat = data.tobytes()
    assert [flat[a:b].decode() for a, b in zip(starts, ends)] == [w for t in texts for w in WORD.findall(t or "")]
    assert np.diff(before).tolist() == [len(WORD.findall(t or "")) for t in texts]
    low, raw = span_hashes(data, starts, ends, lower=True), span_hashes(data, starts, ends)
    assert low[2] == low[3] and raw[2] != raw[3] and raw[1] == raw[-1] and len(set(raw.tolist())) == 6
    at, to, lines = line_spans(data, offsets)
    assert [flat[a:b].decode() for a, b in zip(at, to)] == [x for t in texts for x in (t or "").split("\n")]
    assert span_hashes(data, starts, ends, piece=3).tolist() == raw.tolist()


def brute(steps, scores):
    """Probability of state 1 at each place, over all labelings."""
    n, total, at = len(scores), 0.0, np.zeros(len(scores))
    for code in range(1 << n):
        labels = [(code >> k) & 1 for k in range(n)]
        weight = math.exp(sum(s for s, y in zip(scores, labels) if y) + sum(steps[a][b] for a, b in zip([0, *labels], labels)))
        total += weight
        at += weight * np.array(labels)
    return at / total


def test_marginals_equal_all_labelings():
    rng = np.random.default_rng(3)
    steps = rng.normal(size=(2, 2))
    lengths = [3, 0, 6, 1]
    before = np.concatenate([[0], np.cumsum(lengths)])
    scores = rng.normal(size=before[-1]) * 2
    got = crf.marginals(scores, before, steps)
    for a, b in zip(before, before[1:]):
        assert np.allclose(got[a:b], brute(steps, scores[a:b]))


def test_runs_between_equal_full_passes():
    rng = np.random.default_rng(4)
    steps, quiet = rng.normal(size=(2, 2)), -1.3
    scores = np.full(60, quiet)
    listed = np.array([2, 3, 10, 31, 59])
    scores[listed] = rng.normal(size=5) * 3
    full = crf.marginals(scores, np.array([0, 20, 25, 60]), steps)
    before = np.array([0, 3, 3, 5])
    gaps = np.array([2, 0, 6, 6, 27])
    got = crf.marginals(scores[listed], before, steps, crf.runs_between(quiet, steps, gaps, np.array([9, 5, 0])))
    assert np.allclose(got, full[listed])


def test_fit_lowers_the_loss_by_its_gradient():
    rng = np.random.default_rng(5)
    features = np.column_stack([np.ones(200), rng.normal(size=200)])
    labels = (features[:, 1] + rng.normal(size=200) / 4 > 0).astype(int)
    before = np.arange(0, 201, 10)
    chain = crf.fit(features, labels, before)
    assert ((crf.marginals(chain.scores(features), before, chain.steps) > 0.5) == labels).mean() > 0.9


def corpus(n, seed=0):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        bad = rng.random() < 0.3
        lines = [" ".join(words(rng, 12)) + "." for _ in range(rng.randint(2, 8))]
        if bad:
            kind, at = rng.randrange(3), rng.randrange(2)
            for k in range(at, len(lines)):
                made = words(rng, 12)
                lines[k] = [" ".join(made[:2] * 8), " ".join(w + "###" for w in made), " ".join(made).upper() + "!!"][kind]
        rows.append(("\n".join(lines), int(not bad)))
    return pd.DataFrame(rows, columns=["text", "label"])


def test_quality_learns_lines():
    model = quality.fit_sample(corpus(300))
    held = corpus(200, seed=1)
    scores = np.concatenate([model.score(d, o) for *_, d, o in blocks(pa.array(held.text))])
    assert ((scores >= 0.3) == (held.label == 1)).mean() > 0.95
    good, bad = (quality.line_labels(held.text[held.label == y].iloc[0], model) for y in (1, 0))
    assert [line for line, _ in good] == held.text[held.label == 1].iloc[0].split("\n")
    assert min(p for _, p in good) > 0.5 > min(p for _, p in bad)


def test_quality_edges(spark, edge_docs, no_docs):
    rows = corpus(80)
    docs = spark.createDataFrame([(int(k), t) for k, t in enumerate(rows.text)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(int(k), int(y)) for k, y in enumerate(rows.label)] + [(None, 1), (3, None)], "doc_id bigint, quality int")
    model = quality.fit(docs, labels)
    got = quality.score(edge_docs, model).collect()
    assert len(got) == 9 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)
    assert len({r["score"] for r in got if r["doc_id"] == 5}) == 1
    assert "Score" not in got[0].asDict() and "ids" in got[0].asDict()
    assert quality.score(no_docs, model).count() == 0
    none = quality.fit(docs, labels.where("quality = 1"))
    assert {r["score"] for r in quality.score(edge_docs, none).collect()} == {1.0}
    assert {r["score"] for r in quality.score(edge_docs, quality.fit(docs, labels.where("false"))).collect()} == {0.5}


def toxic_corpus(n, seed=0):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        made, toxic = words(rng, 60), rng.random() < 0.25
        if toxic:
            for _ in range(3):
                made[rng.randrange(60)] = rng.choice(["zutvak", "Zutvak,", "grolp", "vexor" + rng.choice(["ba", "ti", "no"])])
        rows.append((" ".join(made), int(toxic)))
    return pd.DataFrame(rows, columns=["text", "label"])


def test_toxicity_learns_words_stems_and_spans(spark):
    model = toxicity.fit_sample(toxic_corpus(600))
    held = toxic_corpus(300, seed=1)
    docs = spark.createDataFrame([(int(k), t) for k, t in enumerate(held.text)], "doc_id bigint, text string")
    got = toxicity.score(docs, model).orderBy("doc_id").toPandas()
    assert ((got.score >= 0.7) == (held.label == 1)).mean() > 0.97
    one = toxicity.score(spark.createDataFrame([(1, "élan ba zutvak grolp ki")], "doc_id bigint, text string"), model).first()
    assert [("élan ba zutvak grolp ki")[s["start"]:s["end"]] for s in one["spans"]] == ["zutvak grolp"]


def test_toxicity_edges(spark, edge_docs, no_docs):
    model = toxicity.fit_sample(toxic_corpus(400))
    got = {(r["doc_id"], r["score"]): r for r in toxicity.score(edge_docs, model).collect()}
    assert len({s for d, s in got if d in (2, 3, 7)}) == 1 and all(0 <= s <= 1 for _, s in got)
    assert len({s for d, s in got if d == 5}) == 1
    assert toxicity.score(no_docs, model).count() == 0
    clean = toxicity.fit_sample(pd.DataFrame({"text": ["a b"], "label": [0]}))
    assert {(r["score"], len(r["spans"])) for r in toxicity.score(edge_docs, clean).collect()} == {(0.0, 0)}


def brute_counts(text):
    found = WORD.findall(text)
    triples = collections.Counter(zip(found, found[1:], found[2:]))
    covered = {k + s for k, t in enumerate(zip(found, found[1:], found[2:])) if triples[t] > 1 for s in range(3)}
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        dup += bool(WORD.search(line)) and line in seen
        seen.add(line)
    return len(found), sum(map(len, found)), len(re.findall("[#*$%&|<>]", text)), dup, len(covered)


def test_counts_equal_brute_force(edge_docs, no_docs, make_text):
    texts = [make_text(k, 30) * (1 + k % 3) for k in range(20)] + ["a b a b a b", "x\nx\nx", " \n \n", "#a #b\n#a #b", ""]
    counts = [pd.DataFrame(rules.counts_of(d, o)) for *_, d, o in blocks(pa.array(texts))]
    assert [tuple(r) for r in pd.concat(counts).iloc[:, :5].itertuples(index=False)] == [brute_counts(t) for t in texts]
    got = rules.judge(edge_docs, rules.DecisionList()).collect()
    for row in got:
        assert (row["n_words"], row["word_chars"], row["n_symbols"], row["n_dup_lines"], row["n_repeat_words"]) == brute_counts(row["text"] or "")
        assert row["verdict"] and row["base_failed"] == (row["n_words"] < 50 or 2 * row["n_repeat_words"] > row["n_words"])
    assert len(got) == 9 and rules.judge(no_docs, rules.DecisionList()).count() == 0


def test_rules_are_learned_and_ordered(spark):
    rng = np.random.default_rng(2)
    rows = pd.DataFrame({"a": rng.random(600), "b": rng.random(600)})
    bad = ((rows.a > 0.8) | ((rows.b < 0.3) & (rows.a < 0.4))).to_numpy()
    learned = rules.learn(rows, bad)
    found = np.zeros(600, dtype=bool)
    for rule in learned.rules:
        found |= rules.covered(rule, rows)
    assert (found == bad).mean() > 0.95 and "reject if a >= " in str(learned) and str(learned).endswith("keep")
    assert rules.learn(rows, np.zeros(600, dtype=bool)).rules == [] and rules.learn(rows.iloc[:0], bad[:0]).rules == []


def test_rules_fit_and_expression(spark):
    rows = corpus(300)
    docs = spark.createDataFrame([(int(k), t) for k, t in enumerate(rows.text)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(int(k), int(y)) for k, y in enumerate(rows.label)], "doc_id bigint, quality int")
    judged = rules.judge(docs, rules.fit(docs, labels)).orderBy("doc_id").toPandas()
    assert (judged.verdict == (rows.label == 1)).mean() > 0.9


def kneser_ney(texts, scored):
    """The same model by dictionaries: (log10 probability, base score, known) of each text."""
    tokens = {k: [lowered(w) for w in WORD.findall(t or "")] + [0] for k, t in scored.items()}
    training = [[lowered(w) for w in WORD.findall(t or "")] + [0] for t in texts]
    single, pairs = collections.Counter(), collections.Counter()
    for row in training:
        single.update(row)
        pairs.update(zip([1, *row], row))
    first, before, kinds = collections.Counter(), collections.Counter(), collections.defaultdict(lambda: [0, 0, 0, 0])
    for (u, w), c in pairs.items():
        first[u] += c
        before[w] += 1
        kinds[u][min(c, 3)] += 1

    def discounts(values):
        ones = collections.Counter(values)
        return lm.estimate(np.array([ones[k] for k in (1, 2, 3, 4)])).tolist()

    d, e, total, n, v = discounts(pairs.values()), discounts(before.values()), sum(before.values()), sum(single.values()), len(single)
    left = sum(e[min(c, 3)] for c in before.values()) / total

    def lower(w):
        return max(before[w] - e[min(before[w], 3)], 0) / total + left / (v + 1)

    def p(u, w):
        if not first[u]:
            return lower(w)
        c = pairs[u, w]
        return max(c - d[min(c, 3)], 0) / first[u] + sum(a * b for a, b in zip(d, kinds[u])) / first[u] * lower(w)

    assert abs(sum(p(1, w) for w in single) + p(1, "never") - 1) < 1e-9
    return {
        k: (sum(math.log10(p(u, w)) for u, w in zip([1, *row], row)), sum(math.log10((single[w] + 1) / (n + v + 1)) for w in row),
            sum(single[w] > 0 for w in row), len(row), n) for k, row in tokens.items()}


@pytest.mark.parametrize("shard", [1 << 22, 500])
def test_model_equals_dictionaries(spark, edge_docs, make_text, monkeypatch, shard):
    monkeypatch.setattr(lm, "WORD_SHARD", shard)
    monkeypatch.setattr(lm, "PAIR_SHARD", shard)
    monkeypatch.setattr(lm, "FLUSH", 700)
    texts = {k: make_text(k % 7, 150) + " Ba ba ba" for k in range(12)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    model = lm.fit(docs)
    asked = {**texts, 100: None, 101: "", 102: "never seen BA ba\x0bni"}
    got = lm.score(spark.createDataFrame(list(asked.items()), "doc_id bigint, text string"), model).collect()
    want = kneser_ney(texts.values(), asked)
    assert len(got) == len(asked)
    for row in got:
        score, base, known, n, total = want[row["doc_id"]]
        assert row["score"] == pytest.approx(score, abs=1e-9) and row["base_score"] == pytest.approx(base, abs=1e-9)
        assert (row["n_known"], row["n_tokens"], row["train_tokens"]) == (known, n, total)


def test_model_edges(edge_docs, no_docs):
    model = lm.fit(edge_docs)
    got = lm.score(edge_docs, model, keep=["doc_id"]).collect()
    assert len(got) == 9 and all(math.isfinite(r["score"]) and r["score"] < 0 for r in got)
    assert len({r["score"] for r in got if r["doc_id"] in (2, 3, 7)}) == 1
    assert lm.perplexity(lm.score(edge_docs, model)).where("perplexity < 1").count() == 0
    empty = lm.fit(no_docs)
    assert {(r["score"], r["train_tokens"], r["n_known"]) for r in lm.score(edge_docs, empty).collect()} == {(0.0, 0, 0)}
    assert lm.score(no_docs, model).count() == 0
    assert lm.fit(edge_docs, F.col("doc_id") == 2).tokens == 1


def test_toxicity_fit_makes_hashes_a_row_at_a_time():
    corpus = toxic_corpus(40)
    spans, whole = [], []
    for *_, data, offsets in blocks(pa.array(corpus["text"], pa.string()), limit=500):
        starts, ends, _, hashes = toxicity.tokens(data, offsets)
        spans.append((data, starts, ends))
        whole.append(hashes)
    assert len(spans) > 3
    for row, want in zip(toxicity.rows_of_hashes(spans), np.concatenate(whole, axis=1), strict=True):
        assert (row == want).all()


def test_sample_stops_at_a_total_length(spark):
    docs = spark.range(50).select(F.col("id").alias("doc_id"), F.lit("x" * 100).alias("text"))
    labels = spark.range(50).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("toxic"))
    assert len(sample(docs, labels, "toxic", 40, 200)) == 40
    assert len(sample(docs, labels, "toxic", 40, 200, most_total=1000)) == 10
    assert len(sample(docs, labels, "toxic", 40, 200, most_total=50)) == 0


def test_pair_counts_hold_what_is_different():
    texts = pa.array([" ".join(words(random.Random(k % 40), 3000)) for k in range(400)])
    batches = [pa.RecordBatch.from_arrays([texts], names=["text"])] * 2
    tracemalloc.start()
    found = [lm.folded(held) for held in lm.gathered(batches, 0, lambda hashes, total: lm.tally(hashes))]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    found = lm.folded(found)
    every = [h for held in lm.gathered(batches[:1], 0, lambda hashes, total: (hashes,)) for h, in held]
    keys, times = lm.tally(np.concatenate(every))
    assert times.sum() == 400 * 3001 and found[0].tolist() == keys.tolist() and found[1].tolist() == (2 * times).tolist()
    # Whole blocks of hashes would be 8 bytes a token before anything is done with them, and were ten times that.
    assert peak < 35e6, peak


def test_folded_sums_and_empties():
    a = (np.array([1, 3], dtype=lm.U), np.array([250, 1], dtype=np.uint8), np.array([7, 9]))
    b = (np.array([1, 2], dtype=lm.U), np.array([250, 4], dtype=np.uint8), np.array([7, 8]))
    held = [a, b]
    keys, times, other = lm.folded(held)
    assert (keys.tolist(), times.tolist(), other.tolist(), held) == ([1, 2, 3], [500, 4, 1], [7, 8, 9], [])


def test_quality_scores_small_blocks(spark, make_text):
    class Sized:
        def score(self, data, offsets):
            return np.full(len(offsets) - 1, float(len(data)))

    docs = spark.createDataFrame([(k, make_text(k, 3000)) for k in range(60)], "doc_id bigint, text string").coalesce(1)
    found = quality.score(docs, Sized()).toPandas()
    assert len(found) == 60 and found["text"].str.len().sum() > 3 * quality.BLOCK and found["score"].max() <= quality.BLOCK
