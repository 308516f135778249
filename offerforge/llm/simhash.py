"""Near duplicates by SimHash fingerprints, with exact neighbour search through vantage-point trees.

A tree made from a bounded sample routes fingerprints to shards: at each node by the Hamming distance to a vantage point,
inside or outside the median. A fingerprint lives in one shard and is asked in every shard that its ball may reach by the
triangle bound, so no pair is missed. Inside a shard the same kind of tree narrows queries and points down together until
few are left, which are compared. What leaves a shard is a forest of links, never all pairs of a group.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerforge.llm import jaccard
from offerforge.llm.components import components
from offerforge.llm.frames import map_rows, put_back, set_aside, texts
from offerforge.session import text_batches, written

SEED = 42
WORDS = 3
RADIUS = 3
ROUTER_SAMPLE = 8192
POINTS_A_SHARD = 100_000
LEAST_LEVELS = 4
#: Share of fingerprints that a ball of radius 3 sends to both sides of a node, from the spread of unrelated ones.
BOTH_SIDES = 1.6
LEAF_POINTS = 48
#: The wider search: bits that a pair may differ in, the distance for which recall is asked, rows that agree by chance.
WIDE_RADIUS = 16
#: Bits that it may differ in over both fingerprints of 64 bits.
WIDE_TOTAL = 27
WIDE_DISTANCE = 10
WIDE_RECALL = 0.95
ROWS_A_BUCKET = 32
SIMILARITY = 0.8
PAIRS_AT_ONCE = 1 << 21


def fingerprints(docs: DataFrame, words: int = WORDS, key: str = "doc_id", text: str = "text", second: bool = False) -> DataFrame:
    """doc_id and ``fp`` (long, the 64 bits as they are) of every row; with ``second`` also ``fp2``, of the mixed hashes.

    Bytes A-Z are lower-cased, words end at ASCII white space, shingles are ``words`` words with one blank between,
    repeats included; a text of fewer words is one shingle. A bit is set if it is in over half the shingles' XXH64.
    A null text or one without words has fingerprint zero. Repeated rows and null keys are kept.
    """

    def make(batch):
        import xxhash

        digest, rows = xxhash.xxh64_intdigest, []
        for doc, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            found = body.encode().lower().split()
            if len(found) > words:
                shingles = map(b" ".join, zip(*(found[k:] for k in range(words)), strict=False))
            else:
                shingles = [b" ".join(found)] if found else []
            hashes = np.array([digest(s, SEED) for s in shingles], dtype="<u8")
            row = {"doc_id": doc, "fp": _majority(hashes)}
            rows.append(row | {"fp2": _majority(_mixed(hashes))} if second else row)
        return rows

    return map_rows(texts(docs, key, text, "doc_id"), make, "doc_id long, fp long" + ", fp2 long" * second)


def _mixed(hashes: np.ndarray) -> np.ndarray:
    """Other hashes of the same shingles, by multiplications and shifts that reach every bit."""
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        hashes = (hashes ^ (hashes >> np.uint64(shift))) * np.uint64(factor)
    return hashes ^ (hashes >> np.uint64(31))


def _majority(hashes: np.ndarray) -> int:
    if not len(hashes):
        return 0
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 65536):
        bits = np.unpackbits(hashes[at : at + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<i8")[0])


def _split(points: np.ndarray, rng: np.random.Generator) -> tuple[np.uint64, int, np.ndarray] | None:
    """A vantage point, the median distance, and the distances; None if no vantage point tells the points apart."""
    for vantage in points[rng.integers(0, len(points), 3)]:
        far = np.bitwise_count(points ^ vantage)
        median = int(np.median(far))
        if median == far.max():
            median -= 1
        if 0 < np.count_nonzero(far <= median) < len(points):
            return vantage, median, far
    return None


def router(sample: np.ndarray, levels: int) -> tuple | int:
    """Nested (vantage, median, inside, outside) with shard numbers as leaves."""
    rng, shard = np.random.default_rng(SEED), iter(range(1 << levels))

    def grow(points: np.ndarray, level: int):
        cut = _split(points, rng) if level < levels and len(points) > 1 else None
        if cut is None:
            return next(shard)
        vantage, median, far = cut
        return vantage, median, grow(points[far <= median], level + 1), grow(points[far > median], level + 1)

    return grow(sample, 0)


def route(tree: tuple | int, fps: np.ndarray, radius: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """For each shard: the rows that live there and the further rows whose balls may reach it."""
    out = []

    def down(node, home: np.ndarray, guests: np.ndarray) -> None:
        if not len(home) and not len(guests):
            return
        if not isinstance(node, tuple):
            out.append((node, home, guests))
            return
        vantage, median, inside, outside = node
        near, seen = np.bitwise_count(fps[home] ^ vantage).astype(int), np.bitwise_count(fps[guests] ^ vantage).astype(int)
        down(inside, home[near <= median],
             np.concatenate([home[(near > median) & (near - radius <= median)], guests[seen - radius <= median]]))
        down(outside, home[near > median],
             np.concatenate([home[(near <= median) & (near + radius > median)], guests[seen + radius > median]]))

    down(tree, np.arange(len(fps)), np.arange(0))
    return out


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that join the same nodes as the given ones; at most one for each node when there are many."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    if len(a) <= len(nodes):
        return a, b
    x, y = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, x, least)
        np.minimum.at(new, y, least)
        new = new[new]
        if (new == label).all():
            return nodes[label], nodes
        label = new


def search(points: np.ndarray, queries: np.ndarray, radius: int, keep=None) -> tuple[np.ndarray, np.ndarray]:
    """Positions of linked (point, query): a forest of the pairs at ``radius`` or less, equal fingerprints apart. With
    ``keep``, which tells from positions the pairs that count, all these pairs: they are still to be tested, so none may
    stand for another."""
    rng = np.random.default_rng(SEED)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    work = [(np.arange(len(points)), np.arange(len(queries)))]
    while work:
        p, q = work.pop()
        if not len(p) or not len(q):
            continue
        cut = _split(points[p], rng) if len(p) > LEAF_POINTS and len(q) > LEAF_POINTS else None
        if cut is None:
            step = max(1, PAIRS_AT_ONCE // len(q))
            for at in range(0, len(p), step):
                far = np.bitwise_count(points[p[at : at + step], None] ^ queries[None, q])
                i, j = np.nonzero((far <= radius) & (far > 0))
                a, b = p[at + i], q[j]
                if keep is not None:
                    good = keep(a, b)
                    a, b = a[good], b[good]
                if len(a):
                    found.append(_forest(a, len(points) + b) if keep is None else (a, len(points) + b))
            continue
        vantage, median, far = cut
        seen = np.bitwise_count(queries[q] ^ vantage).astype(int)
        work.append((p[far <= median], q[seen - radius <= median]))
        work.append((p[far > median], q[seen + radius > median]))
    if not found:
        return np.arange(0), np.arange(0)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def links(nodes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (a, b) between the ``id`` of rows of ``nodes`` (fp, id; each fp once) whose fingerprints differ in at most
    ``radius`` bits: enough links to join what is connected. ``nodes`` is read three times.

    The shards follow the number of fingerprints; a shard with many guests is asked in parts of its own, so no task holds
    more than a bounded number of fingerprints.
    """
    total = nodes.count()
    levels = LEAST_LEVELS
    while total >> levels > POINTS_A_SHARD:
        levels += 1
    parts = max(1, round(BOTH_SIDES**levels / 10))
    some = nodes.where(F.pmod(F.xxhash64("fp"), F.lit(max(total, 1))) < ROUTER_SAMPLE).select("fp").limit(ROUTER_SAMPLE)
    tree = router(np.array(sorted(r["fp"] for r in some.collect()), dtype="<i8").view("<u8"), levels)

    def send(batches):
        for batch in batches:
            fps, ids = (np.asarray(batch.column(k)).astype("<i8") for k in (0, 1))
            bits = fps.view("<u8")
            for shard, home, guests in route(tree, bits, radius):
                for rows, part, lives in (
                    [(home, np.full(len(home), k), True) for k in range(parts)] + [(guests, bits[guests] % parts, False)]
                ):
                    yield pa.RecordBatch.from_pydict({
                        "shard": pa.array(shard * parts + part.astype("<i8"), pa.int64()),
                        "fp": pa.array(fps[rows], pa.int64()), "id": pa.array(ids[rows], pa.int64()),
                        "lives": pa.array(np.full(len(rows), lives), pa.bool_()),
                    })

    def look(group: pa.Table) -> pa.Table:
        fps = group.column("fp").to_numpy().view("<u8")
        ids, lives = group.column("id").to_numpy(), group.column("lives").to_numpy()
        order = np.argsort(~lives, kind="stable")  # who lives here is asked as well, in one part
        points = order[: np.count_nonzero(lives)]
        asked = order if not int(group.column("shard")[0].as_py()) % parts else order[len(points) :]
        a, b = search(fps[points], fps[asked], radius)
        both = np.concatenate([points, asked])
        a, b = ids[both[a]], ids[both[b]]
        return pa.table({"a": a[a != b], "b": b[a != b]}, schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    sent = nodes.select("fp", "id").mapInArrow(send, "shard long, fp long, id long, lives boolean")
    return sent.groupBy("shard").applyInArrow(look, "a long, b long")


def group_near_duplicates(docs: DataFrame, words: int = WORDS, radius: int = RADIUS, key: str = "doc_id",
                          text: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, fp, component_id (the smallest doc_id reachable over links, itself included).

    Fingerprints are written once; equal ones become one node before the search, so copies cost one row each. A row with
    a null key has the component of its fingerprint's other rows, null if none has a key. Rows alike share all. No rows
    give no rows.
    """
    prints = written(fingerprints(docs, words, key, text))
    nodes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("id"), F.count("*").alias("n")).where("id IS NOT NULL"))
    joined = components(links(nodes, radius))
    reached = nodes.join(joined, nodes["id"] == joined["node"], "left").select(
        "fp", F.coalesce("component", "id").alias("component"), (F.col("component").isNotNull() | (F.col("n") > 1)).alias("more"))
    reached = reached.where("more").drop("more")
    return prints.join(reached, "fp", "left").select("doc_id", "fp", F.coalesce("component", "doc_id").alias("component_id"))


def wide_pairs(nodes: DataFrame, radius: int = WIDE_RADIUS, total: int = WIDE_TOTAL, distance: int = WIDE_DISTANCE, recall: float = WIDE_RECALL) -> DataFrame:
    """Pairs (a, b) of the ``id`` of rows of ``nodes`` (fp, fp2, id) at ``radius`` bits or less, and ``total`` bits or less with
    the second fingerprint, which keeps chance pairs out. They are too far for shards that balls reach: at such a radius a
    ball reaches every shard.

    A table is a sample of bits, a shard the rows that agree on them; inside a shard vantage-point trees search as above. The
    sampled bits follow the number of rows, so that shards stay small, and the tables follow the bits, so that two
    fingerprints at ``distance`` share a shard with probability ``recall``, nearer ones with a higher one. All pairs of a
    shard are given, as no pair says anything of another before the texts are compared. It may miss pairs; ``group_similar``
    does not use it.
    """
    count = max(2, nodes.count())
    bits = max(4, math.ceil(math.log2(count / ROWS_A_BUCKET)))
    tables = math.ceil(math.log(1 - recall) / math.log(1 - (1 - distance / 64) ** bits))
    rng = np.random.default_rng(SEED)
    masks = [sum(1 << int(b) for b in rng.permutation(64)[:bits]) for _ in range(tables)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keys = F.array(*[F.struct(F.lit(t).alias("table"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for t, m in enumerate(signed)])
    rows = nodes.select("fp", "fp2", "id", F.explode(keys).alias("k")).select("k.table", "k.key", "fp", "fp2", "id")

    def look(batches):
        held = None
        for columns in itertools.chain(([np.asarray(c) for c in b.columns] for b in batches), [None]):
            if columns is not None:
                held = columns if held is None else [np.concatenate(x) for x in zip(held, columns, strict=True)]
            if held is None or not len(held[0]):
                continue
            ends = np.nonzero((np.diff(held[0]) != 0) | (np.diff(held[1]) != 0))[0] + 1
            starts = [0, *ends.tolist()]
            if columns is None:
                starts.append(len(held[0]))
            found = []
            for low, high in zip(starts, starts[1:], strict=False):
                if high - low > 1:
                    fps, more, ids = held[2][low:high].view("<u8"), held[3][low:high].view("<u8"), held[4][low:high]
                    a, b = search(fps, fps, radius, lambda a, b, f=fps, m=more: (
                        np.bitwise_count(f[a] ^ f[b]) + np.bitwise_count(m[a] ^ m[b]) <= total))
                    b = b - len(fps) * (b >= len(fps))
                    a = a - len(fps) * (a >= len(fps))
                    found.append(np.unique(np.sort(np.stack([ids[a], ids[b]], axis=1), axis=1), axis=0))
            held = [c[starts[-1] :] for c in held]
            if found:
                pairs = np.concatenate(found)
                pairs = pairs[pairs[:, 0] != pairs[:, 1]]
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    dealt = rows.repartition("table", "key").sortWithinPartitions("table", "key", "id")
    return dealt.mapInArrow(look, "a long, b long").distinct()


def nearest_pairs(docs: DataFrame, keys: DataFrame, words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """Pairs (a, b) of ``keys`` (doc_id) that join what fingerprints of their texts in ``docs`` (doc_id, text) at ``radius`` bits
    or less join, found as in ``group_near_duplicates``; at most some for each key, as a dense group is given as a star. Equal
    fingerprints are one point of the trees; its rows are paired with their smallest key."""
    with text_batches(docs.sparkSession):
        prints = written(fingerprints(docs, words).join(keys, "doc_id", "left_semi"))
    nodes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("id")))
    same = prints.join(nodes, "fp").select(F.col("id").alias("a"), F.col("doc_id").alias("b")).where("a != b")
    return written(links(nodes, radius).union(same))


def group_similar(docs: DataFrame, words: int = 5, similarity: float = SIMILARITY, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id and component_id, for near copies of a Jaccard index of at least ``similarity``.

    Fingerprints go through the vantage-point trees first and the pairs found there are tested. Near copies of more edits
    differ in more bits than a ball can hold, so an exact search over shingles follows for what is not joined by then: groups
    are joined by pairs of that index alone and no pair is missed, see ``jaccard``. Nulls, repeated and empty rows as in
    ``group_near_duplicates``; texts under one key count as one document.
    """
    rows = texts(docs, key, text, "doc_id")
    return jaccard.group(rows, words, similarity, lambda keys: nearest_pairs(rows, keys))


def keep_one(docs: DataFrame, words: int = 5, similarity: float = SIMILARITY, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each group of ``group_similar``, that with the smallest key. Rows with a null key stay."""
    ids = group_similar(docs, words, similarity, key, text).where("doc_id = component_id")
    ids = written(ids.groupBy(F.col("doc_id").alias("_kept")).agg(F.count("*").alias("_rows")))
    rows, names = set_aside(docs)
    # the keys kept grow with the documents, so they are never broadcast
    found = rows.join(ids.hint("merge"), F.col(names[key]) == F.col("_kept"))
    once = found.where("_rows = 1").select(*names.values())
    again = found.where("_rows > 1").select(*names.values()).dropDuplicates([names[key]])
    return once.unionByName(again).unionByName(rows.where(F.col(names[key]).isNull())).select(*put_back(names))
