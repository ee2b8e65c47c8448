"""Joining documents by the Jaccard similarity of their word shingles, with parity sketches.

A document is the set of its distinct shingles of so many words (the whole sequence as one if it
has fewer). Two sets that link differ in few members: similarity ``share`` bounds the symmetric
difference by (1 - share) / (1 + share) of both sizes together. Hashing every member into one of
K segments by exclusive or gives a sketch; a member of only one set changes one segment, so the
number of unequal segments is at most the symmetric difference. With K one more than the bound,
sets that link have an equal segment. Sizes are banded so that sets that link lie in the same or
neighbouring bands, and K belongs to a band.

Steps: equal sets become one by a digest. Segments that several sets share are found on hashed
slices of all keys. Members of such a bucket are compared with its smallest member; components
of these links leave few buckets with several components, and only there all pairs of different
components are compared, first by a bit sketch whose Hamming distance cannot exceed the symmetric
difference, then exactly. So no link between components is lost and copies are never paired
with each other. Only pairs that pass the bit sketch leave a task.

Null and empty texts have an empty set, which links with nothing: they are their own component.
Repeated rows count as copies. Rows of one id are one document: what one of its texts links with,
all of them reach, but each text is compared as it is. In ``one_of_each`` an id with unlike texts
keeps all of them. A row without an id is returned with a null component and links with nothing.
An empty table gives an empty table. Other columns play no part.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.columns import U, blocks, mix, ngram_hashes, owners, repeated, span_hashes, texts_only, word_spans
from shelfcast.llm.components import components
from shelfcast.session import forget, written

SLICE = 1 << 20  # keys in one hashed slice, about
FLUSH = 1 << 21  # keys a task holds before it hands them on
KEY = 6  # bytes of a key that travel: keys that meet by chance fail the check of their sets
BLOCK = 512  # sets of a key that are compared with so many others in a task


class Bands:
    """Sizes at which bands begin, and the number of segments of each band."""

    def __init__(self, num: int, den: int, largest: int = 1 << 40):
        self.num, self.den = num, den
        edges = [1]
        while edges[-1] <= largest:
            edges.append(edges[-1] * den // num + 1)
        self.edges = np.array(edges, dtype=np.int64)
        self.segments = (den - num) * 2 * (self.edges[1:] - 1) // (den + num) + 1

    def of(self, sizes: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.edges, sizes, "right") - 1


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles of every document (in no order), and their number before each."""
    starts, ends, before = word_spans(data, offsets)
    words = span_hashes(data, starts, ends, lower=True)
    found, total = ngram_hashes(words, before, width)
    owner = owners(total)
    short = np.flatnonzero((np.diff(before) > 0) & (np.diff(before) < width))
    with np.errstate(over="ignore"):
        few = np.array([mix(np.array([_fold(words[before[k]:before[k + 1]])], dtype=U))[0] for k in short], dtype=U)
    found, owner = np.concatenate([found, few]), np.concatenate([owner, short])
    fresh = ~repeated(found, owner)[1]
    found, owner = found[fresh], owner[fresh]
    order = np.argsort(owner, kind="stable")
    return found[order], np.searchsorted(owner[order], np.arange(len(offsets)))


def _fold(words: np.ndarray) -> int:
    out = len(words)
    for w in words.tolist():
        out = (out * 0xD6E8FEB86659FD93 + w) % (1 << 64)
    return out


def segment_keys(members: np.ndarray, before: np.ndarray, bands: Bands) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all segments of every set, for its own band and the one above, and their number
    before each set. Sets that link share a key."""
    sizes = np.diff(before)
    owner, band = owners(before), bands.of(np.maximum(sizes, 1))
    parts, counts = [], []
    for up in (0, 1):
        group = band + up
        segments = np.where(sizes > 0, bands.segments[group], 0)
        first = np.concatenate([[0], np.cumsum(segments)])
        salt = mix(group.astype(U) + U(0x5851F42D4C957F2D))
        with np.errstate(over="ignore"):
            spread = mix(members ^ salt[owner])
            place = ((spread >> U(32)) * segments[owner].astype(U) >> U(32)).astype(np.int64) + first[owner]
            sketch = np.zeros(first[-1], dtype=U)
            np.bitwise_xor.at(sketch, place, mix(spread))
            segment = np.arange(first[-1]) - np.repeat(first[:-1], segments)
            keys = mix(sketch ^ mix(segment.astype(U) + U(1)) ^ np.repeat(salt, segments))
        parts.append(keys)
        counts.append(segments)
    total = np.concatenate([[0], np.cumsum(counts[0] + counts[1])])
    out = np.zeros(total[-1], dtype=U)
    for up, (keys, segments) in enumerate(zip(parts, counts)):
        at = total[:-1] + (counts[0] if up else 0)
        out[np.arange(len(keys)) + np.repeat(at - np.concatenate([[0], np.cumsum(segments)[:-1]]), segments)] = keys
    return out, total


def bit_sketches(members: np.ndarray, before: np.ndarray) -> list[bytes]:
    """For every set, bits in which each member flips one: a power of two of them, over twice the
    size of the set. The lower half xor the upper half is the sketch of half the length."""
    sizes = np.diff(before)
    bits = np.maximum(64, 1 << np.ceil(np.log2(np.maximum(2 * sizes, 2))).astype(np.int64))
    words = bits // 64
    first = np.concatenate([[0], np.cumsum(words)])
    owner = owners(before)
    place = (mix(members ^ U(0x2545F4914F6CDD1D)) & (bits[owner] - 1).astype(U)).astype(np.int64)
    flat = np.zeros(first[-1], dtype=U)
    np.bitwise_xor.at(flat, first[owner] + place // 64, U(1) << (place % 64).astype(U))
    raw = flat.tobytes()
    return [raw[8 * a:8 * b] for a, b in zip(first.tolist(), first[1:].tolist())]


def fold_sketch(sketch: bytes, length: int) -> np.ndarray:
    words = np.frombuffer(sketch, dtype=U)
    while 8 * len(words) > length:
        words = words[:len(words) // 2] ^ words[len(words) // 2:]
    return words


def marked(docs: DataFrame, id_column: str, text: str) -> DataFrame:
    """(id, text, mark): ``mark`` tells the texts of one id apart."""
    return texts_only(docs, id_column, text).select(F.col(id_column).alias("id"), F.col(text).alias("text"), F.md5(text).alias("mark"))


def key_counts(sizes: np.ndarray, bands: Bands) -> np.ndarray:
    """Number of keys of sets of these sizes, as ``segment_keys`` makes them."""
    band = bands.of(np.maximum(sizes, 1))
    return np.where(sizes > 0, bands.segments[band] + bands.segments[band + 1], 0)


def describe(docs: DataFrame, width: int, num: int, den: int, id_column: str, text: str) -> DataFrame:
    """(id, mark, n, digest_a, digest_b, n_keys, sketch) of every document."""
    source = marked(docs, id_column, text)
    kind = source.schema[0].dataType.simpleString()
    names = ["id", "mark", "n", "digest_a", "digest_b", "n_keys", "sketch"]
    bands = Bands(num, den)

    def run(batches):
        for batch in batches:
            for low, high, _, data, offsets in blocks(batch.column(1)):
                members, before = shingle_sets(data, offsets, width)
                with np.errstate(over="ignore"):
                    digests = [np.diff(np.concatenate([[U(0)], np.cumsum(mix(members ^ salt), dtype=U)])[before]).view(np.int64)
                               for salt in (U(0x8CB92BA72F3D8DD7), U(0x7F4A7C159E3779B9))]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(low, high - low), batch.column(2).slice(low, high - low), pa.array(np.diff(before), pa.int64()),
                    *map(pa.array, digests), pa.array(key_counts(np.diff(before), bands), pa.int64()),
                    pa.array(bit_sketches(members, before), pa.binary())], names=names)

    return source.mapInArrow(run, f"id {kind}, mark string, n bigint, digest_a bigint, digest_b bigint, n_keys bigint, sketch binary")


def texts_of(sets: DataFrame, docs: DataFrame, id_column: str, text: str) -> DataFrame:
    """(node, text) of sets (node, id, mark). A repeated row gives its node again."""
    texts = marked(docs, id_column, text).withColumn("id", F.col("id").cast("bigint"))
    return texts.join(sets.select("node", "id", "mark"), ["id", "mark"]).select("node", "text")


def keys_of(width: int, num: int, den: int) -> Callable[[pa.Array], Iterator[tuple[int, int, np.ndarray, np.ndarray]]]:
    """Makes the keys of texts, block by block: rows from, rows to, the keys and their number before each
    row. Keys are larger than a packed text, so they are made where they are dealt out and never stored."""
    bands = Bands(num, den)

    def made(texts: pa.Array):
        for low, high, _, data, offsets in blocks(texts):
            yield low, high, *segment_keys(*shingle_sets(data, offsets, width), bands)

    return made


def stored_keys(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """The same from keys that are there already, as bytes."""
    keys = [np.frombuffer(k, dtype=U) for k in column.to_pylist()]
    yield 0, len(keys), np.concatenate([np.zeros(0, U), *keys]), np.concatenate([[0], np.cumsum([len(k) for k in keys], dtype=np.int64)])


def packed_nodes(nodes: np.ndarray) -> tuple[int, int, bytes]:
    """(first, width, steps) of ascending nodes: the steps between them as whole numbers of that many bytes.
    Steps wrap round at 64 bits, so any nodes will do."""
    steps = np.diff(nodes.view(U), prepend=nodes[:1].view(U))
    kind = np.min_scalar_type(steps.max())
    return int(nodes[0]), kind.itemsize, steps.astype(kind).tobytes()


def unpacked_nodes(first: int, width: int, steps: bytes) -> np.ndarray:
    made = np.cumsum(np.frombuffer(steps, dtype=f"u{width}"), dtype=U)
    with np.errstate(over="ignore"):
        return (made + np.array([first], dtype=np.int64).view(U)).view(np.int64)


def shared_keys(sets: DataFrame, slices: int, keys: Callable = stored_keys) -> DataFrame:
    """(key, node) of all keys that several nodes have, from rows of a node and what ``keys`` makes its keys of.

    A task hands on at most one entry for a key and its other entries as known to be shared,
    spread over all slices; so a slice holds no more of one key than there are tasks' worth. Entries
    of a slice go by node, so that a node is a small step from the one before and not a whole number.
    A node that comes again has the same keys."""
    def cut(batches):
        held, size, seen = [], 0, set()
        for batch in batches:
            fresh = np.zeros(batch.num_rows, dtype=bool)
            for row, node in enumerate(batch.column(0).to_pylist()):
                fresh[row] = node not in seen
                seen.add(node)
            nodes, source = batch.column(0).to_numpy()[fresh], batch.column(1).filter(pa.array(fresh))
            for low, high, made, before in keys(source):
                held.append((made & U((1 << 8 * KEY) - 1), np.repeat(nodes[low:high], np.diff(before))))
                size += len(made)
                if size >= FLUSH:
                    yield hand_on(held)
                    held, size, seen = [], 0, set(nodes[high:].tolist())
        if size:
            yield hand_on(held)

    def hand_on(held):
        keys, nodes = (np.concatenate(part) for part in zip(*held))
        order = np.argsort(keys, kind="stable")
        keys, nodes = keys[order], nodes[order]
        again = np.zeros(len(keys), dtype=bool)
        again[1:] = keys[1:] == keys[:-1]
        followed = np.zeros(len(keys), dtype=bool)
        followed[:-1] = again[1:]
        place = np.where(again, np.arange(len(keys)) % slices, (keys % U(slices)).astype(np.int64))
        state = (again * 2 + (followed & ~again)).astype(np.uint8)  # 2: known, only pass on; 1: known
        order = np.lexsort((nodes, place))
        bounds = np.searchsorted(place[order], np.arange(slices + 1))
        bare = keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :KEY]
        rows = [(p, bare[order[a:b]].tobytes(), *packed_nodes(nodes[order[a:b]]), state[order[a:b]].tobytes())
                for p, (a, b) in enumerate(zip(bounds, bounds[1:])) if a < b]
        kinds = (pa.int32(), pa.binary(), pa.int64(), pa.int32(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays(
            [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)],
            names=["slice", "keys", "first", "width", "steps", "state"])

    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        bare, state = (np.frombuffer(b"".join(pdf[c]), dtype=np.uint8) for c in ("keys", "state"))
        keys = np.zeros((len(state), 8), dtype=np.uint8)
        keys[:, :KEY] = bare.reshape(-1, KEY)
        keys = keys.view("<u8")[:, 0].astype(U)
        nodes = np.concatenate([unpacked_nodes(*row) for row in zip(pdf["first"], pdf["width"], pdf["steps"])])
        known = state == 2
        rest = np.flatnonzero(~known)
        order = rest[np.argsort(keys[rest], kind="stable")]
        ranked = keys[order]
        same = ranked[1:] == ranked[:-1]
        shared = state[order] == 1
        shared[1:] |= same
        shared[:-1] |= same
        kept = np.concatenate([np.flatnonzero(known), order[shared]])
        return pd.DataFrame({"key": keys[kept].view(np.int64), "node": nodes[kept]})

    handed = sets.select(F.col(sets.columns[0]).cast("bigint"), sets.columns[1]).mapInArrow(
        cut, "slice int, keys binary, first bigint, width int, steps binary, state binary")
    return handed.groupBy("slice").applyInPandas(meet, "key bigint, node bigint")


def bound(total: np.ndarray, num: int, den: int) -> np.ndarray:
    """Largest symmetric difference of sets that link, from their sizes together."""
    return (den - num) * total // (den + num)


def across(known: DataFrame, sketches: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (a, b) of nodes that share a key, lie in different components and pass the bit
    sketch, from rows (key, node, component) and (node, n, sketch).

    A pair of different components has a member outside of the largest component of its key.
    These members are compared with all. A key of more than ``BLOCK`` members is dealt by hash into
    blocks of about ``BLOCK`` by ``BLOCK``, which many tasks share; only passing pairs leave a task."""
    counted = known.groupBy("key", "component").agg(F.count("*").alias("m"))
    most = counted.groupBy("key").agg(F.max(F.struct("m", "component")).alias("most"), F.sum("m").alias("members")).where("most.m < members")
    found = written(known.join(most, "key").select(
        "key", "node", "component", "members", (F.col("component") == F.col("most.component")).alias("major"),
        F.ceil((F.col("members") - F.col("most.m")) / BLOCK).alias("rows"), F.ceil(F.col("members") / BLOCK).alias("columns")), "open")

    def dealt(part: DataFrame, i: Column, j: Column, side: int) -> DataFrame:
        return part.select("key", i.alias("i"), j.alias("j"), "node", "component", "major", F.lit(side).alias("side"))

    def place(n: str) -> Column:
        return F.pmod(F.xxhash64("node"), F.col(n))

    def every(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))

    zero, large = F.lit(0).cast("bigint"), found.where(f"members > {BLOCK}")
    blocked = dealt(found.where(f"members <= {BLOCK}"), zero, zero, 0).union(
        dealt(large.where("not major"), place("rows"), every("columns"), 1)).union(dealt(large, every("rows"), place("columns"), 2))

    def pairs(rows: pd.DataFrame) -> np.ndarray:
        x, y = rows[(rows["side"] != 2) & ~rows["major"]], rows[rows["side"] != 1]
        if not len(x) or not len(y):
            return np.zeros((0, 2), dtype=np.int64)
        length = min(map(len, rows["sketch"]))
        here, there = (np.stack([fold_sketch(s, length) for s in part["sketch"]]) for part in (x, y))
        (nodes, ours, sizes), (others, theirs, lengths) = ([part[c].to_numpy() for c in ("node", "component", "n")] for part in (x, y))
        major, made = y["major"].to_numpy(), []
        step = max(1, (1 << 20) // (here.shape[1] * len(y)))
        for at in range(0, len(x), step):
            part = slice(at, at + step)
            apart = np.bitwise_count(here[part, None, :] ^ there[None]).sum(axis=2, dtype=np.int64)
            once = major[None] | (nodes[part, None] < others[None])
            i, j = np.nonzero((ours[part, None] != theirs[None]) & once & (apart <= bound(sizes[part, None] + lengths[None], num, den)))
            made.append(np.column_stack([nodes[at + i], others[j]]))
        found = np.concatenate(made)
        return np.column_stack([found.min(axis=1), found.max(axis=1)])

    def run(batches):
        last, held = None, []
        for batch in batches:
            pdf = batch.to_pandas()
            places = pdf[["key", "i", "j"]].to_numpy()
            cuts = np.flatnonzero((places[1:] != places[:-1]).any(axis=1)) + 1
            for a, b in zip(np.concatenate([[0], cuts]), np.concatenate([cuts, [len(pdf)]])):
                if a == b:
                    continue
                if last is not None and (places[a] != last).any():
                    yield from finish(held)
                    held = []
                last = places[a]
                held.append(pdf.iloc[a:b])
        yield from finish(held)

    def finish(held):
        if held:
            found = pairs(pd.concat(held) if len(held) > 1 else held[0])
            if len(found):
                yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["a", "b"])

    by = ["key", "i", "j"]
    return blocked.join(sketches, "node").repartition(*by).sortWithinPartitions(*by).mapInArrow(run, "a bigint, b bigint").distinct()


def near_by_sketch(edges: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) whose bit sketches allow a link."""
    def side(name: str) -> DataFrame:
        return sets.select(F.col("node").alias(name), F.col("n").alias(f"n_{name}"), F.col("sketch").alias(f"s_{name}"))

    def run(batches):
        for batch in batches:
            sizes = (batch.column(2).to_numpy() + batch.column(4).to_numpy()).tolist()
            passed = []
            for x, y, size in zip(batch.column(3).to_pylist(), batch.column(5).to_pylist(), sizes):
                length = min(len(x), len(y))
                apart = int(np.bitwise_count(fold_sketch(x, length) ^ fold_sketch(y, length)).sum())
                passed.append(apart <= bound(size, num, den))
            passed = pa.array(passed, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(k).filter(passed) for k in (0, 1)], names=["a", "b"])

    both = edges.join(side("a"), "a").join(side("b"), "b").select("a", "b", "n_a", "s_a", "n_b", "s_b")
    return both.mapInArrow(run, "a bigint, b bigint")


def verified(edges: DataFrame, sets: DataFrame, docs: DataFrame, width: int, num: int, den: int, id_column: str, text: str) -> DataFrame:
    """The pairs (a, b) that link: their sets are built again from the texts and intersected."""
    wanted = sets.join(edges.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "node", "left_semi").select("node", "id", "mark")
    texts = texts_of(wanted, docs, id_column, text)

    def build(batches):
        for batch in batches:
            for low, high, _, data, offsets in blocks(batch.column(1)):
                members, before = shingle_sets(data, offsets, width)
                rows = [np.sort(members[a:b]).tobytes() for a, b in zip(before, before[1:])]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, high - low), pa.array(rows, pa.binary())], names=["node", "members"])

    built = texts.mapInArrow(build, "node bigint, members binary").groupBy("node").agg(F.any_value("members").alias("members"))  # repeated rows
    built = written(built, "members")

    def run(batches):
        for batch in batches:
            passed = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, y = np.frombuffer(x, dtype=U), np.frombuffer(y, dtype=U)
                both = len(np.intersect1d(x, y, assume_unique=True))
                passed.append(den * both >= num * (len(x) + len(y) - both))
            passed = pa.array(passed, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(k).filter(passed) for k in (0, 1)], names=["a", "b"])

    with_a = edges.join(built.withColumnsRenamed({"node": "a", "members": "m_a"}), "a")
    with_both = with_a.join(built.withColumnsRenamed({"node": "b", "members": "m_b"}), "b").select("a", "b", "m_a", "m_b")
    linked = written(with_both.mapInArrow(run, "a bigint, b bigint").distinct(), "linked")
    forget(built)
    return linked


DIGEST = ["n", "digest_a", "digest_b"]


def groups(
    docs: DataFrame, width: int, num: int, den: int, id_column: str, text: str, by_id: bool,
) -> tuple[DataFrame, DataFrame]:
    """Rows (id, mark, n, digest_a, digest_b) of all documents, and (n, digest_a, digest_b, component)
    of all sets that are not empty. ``by_id`` joins the sets of one id as well."""
    described = written(describe(docs, width, num, den, id_column, text), "described")
    rows = written(described.select("id", "mark", *DIGEST), "rows")
    named = rows.where(F.col("id").isNotNull() & (F.col("n") > 0)).withColumn("id", F.col("id").cast("bigint"))
    ends = [F.struct(*[f(c).alias(c) for c in DIGEST]) for f in (F.min, F.max)]
    several = named.groupBy("id").agg(ends[0].alias("x"), ends[1].alias("y")).where("x != y").select("id", F.lit(True).alias("several"))
    # A set is known by its smallest id, which a star around a key's smallest node does well with; sets of
    # an id that has several get numbers beyond all ids.
    beyond = named.agg(F.max("id")).first()[0] or 0
    number = F.monotonically_increasing_id()
    node = F.when(F.col("several"), beyond + 1 + number).otherwise(F.col("w.id")) if beyond < 1 << 62 else number
    usable = described.where(F.col("id").isNotNull() & (F.col("n") > 0))
    # Copies fold before the shuffle; the set of the smallest id stays, with all it needs.
    whole = F.min(F.struct(F.col("id").cast("bigint").alias("id"), "mark", "n_keys", "sketch")).alias("w")
    folded = usable.groupBy(*DIGEST).agg(whole)
    known_as = folded.join(several.withColumnRenamed("id", "of"), F.col("w.id") == F.col("of"), "left")
    sets = written(known_as.select(node.alias("node"), *DIGEST, "w.*"), "sets")
    forget(described)
    slices = max(1, -(-(sets.agg(F.sum("n_keys")).first()[0] or 0) // SLICE))
    sketches = sets.select("node", "n", "sketch")
    rest_of = (sets, docs, width, num, den, id_column, text)
    shared = written(shared_keys(texts_of(sets, docs, id_column, text), slices, keys_of(width, num, den)), "shared")

    centre = shared.groupBy("key").agg(F.min("node").alias("a"))
    stars = shared.join(centre, "key").where(F.col("node") != F.col("a")).select("a", F.col("node").alias("b")).distinct()
    passing = written(near_by_sketch(stars, sketches, num, den), "stars")
    found = written(components(verified(passing, *rest_of)), "components")

    known = shared.join(found, "node", "left").select("key", "node", F.coalesce("component", "node").alias("component"))
    inner = written(across(known, sketches, num, den), "across")
    forget(shared)
    more = verified(inner, *rest_of)
    if by_id:
        texts = named.join(several, "id", "left_semi").join(sets.select("node", *DIGEST), DIGEST).select("id", "node")
        firsts = texts.groupBy("id").agg(F.min("node").alias("a"))
        more = more.union(texts.join(firsts, "id").where("node != a").select("a", F.col("node").alias("b")))

    def side(name: str, component: str) -> DataFrame:
        return found.select(F.col("node").alias(name), F.col("component").alias(component))

    joined = components(more.join(side("a", "x"), "a", "left").join(side("b", "y"), "b", "left").select(
        F.coalesce("x", "a").alias("a"), F.coalesce("y", "b").alias("b")))
    roots = joined.select(F.col("node").alias("component"), F.col("component").alias("root"))
    membership = sets.join(found, "node", "left").select(*DIGEST, "id", F.coalesce("component", "node").alias("component"))
    classes = membership.join(roots, "component", "left").select(*DIGEST, F.col("id").alias("smallest"), F.coalesce("root", "component").alias("component"))
    return rows, classes


def similar(
    docs: DataFrame, width: int = 5, num: int = 80, den: int = 100, id_column: str = "doc_id", text: str = "text",
) -> DataFrame:
    """(id, n_shingles, component_id): documents linked, directly or through others, by a Jaccard
    similarity of at least num / den of their sets of ``width``-word shingles. Ids are integers;
    ``component_id`` is the smallest id of the component."""
    rows, classes = groups(docs, width, num, den, id_column, text, by_id=True)
    smallest = classes.groupBy("component").agg(F.min("smallest").alias("component_id"))
    named = classes.join(smallest, "component").select(*DIGEST, "component_id")
    own = F.when(F.col("id").isNotNull(), F.coalesce(F.col("component_id"), F.col("id").cast("bigint")))
    return rows.join(named, DIGEST, "left").select(F.col("id").alias(id_column), F.col("n").alias("n_shingles"), own.alias("component_id"))


def one_of_each(
    docs: DataFrame, width: int = 5, num: int = 80, den: int = 100, id_column: str = "doc_id", text: str = "text",
) -> DataFrame:
    """The documents without near copies: of each group of sets that link, directly or through
    others, the row of the smallest id, of an id's texts the one of the smallest digest, of repeated
    rows any one. Rows without an id stay, as do rows without words but for repeats."""
    rows, classes = groups(docs, width, num, den, id_column, text, by_id=False)
    rows = rows.where(F.col("id").isNotNull() & (F.col("n") > 0)).join(classes, DIGEST)
    first = rows.groupBy("component").agg(F.min(F.struct("id", "mark")).alias("first"))
    lost = rows.join(first, "component").where(F.struct("id", "mark") != F.col("first")).select(
        F.col("id").alias("lost_id"), F.col("mark").alias("lost_mark")).distinct()
    # Repeats fold before the shuffle, which serves the join as well.
    own = F.md5(F.coalesce(F.col(text).cast("string"), F.lit("")))
    again = Window.partitionBy(F.col(id_column), "own_mark").orderBy("own_mark")
    known = docs.where(F.col(id_column).isNotNull()).withColumn("own_mark", own)
    single = known.withColumn("own_place", F.row_number().over(again)).where("own_place = 1")
    left = single.join(lost, (F.col(id_column) == F.col("lost_id")) & (F.col("own_mark") == F.col("lost_mark")), "left_anti")
    return left.select(*docs.columns).union(docs.where(F.col(id_column).isNull()))
