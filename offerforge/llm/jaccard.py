"""Groups of texts whose sets of shingles have a Jaccard index of at least a bound, found exactly.

Texts with equal sets become one node. Pairs that another search finds nearest, if one is given, are tested first; what
they join is not tested again. For the rest: two sets over the bound share a shingle in the first part of each, in any order that
is the same for all: the rare ones come first, so few texts meet there by chance. Of those that meet at a shingle all are
tested with the one where it stands foremost, and then only pairs that are not in one group yet. Lengths, places and parity
sketches rule out pairs before their sets are compared; none rules out a pair over the bound.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from offerforge.llm.components import components
from offerforge.session import text_batches, written

SEED = 42
ROWS_AT_ONCE = 256
#: Counters for all shingles, each of which belongs to one by its high bits, in chunks of so many; shared counters change
#: the order and with it the speed, never the result.
COUNTER_BITS, CHUNK_BITS = 21, 14
SALTS = 16
#: Least length of a sketch; what a sketch is folded to where candidates are joined.
SKETCH_BITS = 512
EPS = 1e-9
STEP = np.uint64(0x9E3779B97F4A7C15)


def mixed(hashes: np.ndarray) -> np.ndarray:
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        hashes = (hashes ^ (hashes >> np.uint64(shift))) * np.uint64(factor)
    return hashes ^ (hashes >> np.uint64(31))


def shingles(text: str, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of all runs of ``words`` lower-cased words (ended by ASCII white space); of a shorter
    text its words as one run."""
    import xxhash

    found = text.lower().encode(errors="surrogatepass").split()
    each = np.fromiter((xxhash.xxh64_intdigest(w, SEED) for w in found), dtype=np.uint64, count=len(found))
    run = min(words, len(each))
    total = np.full(len(each) - run + 1, run, dtype=np.uint64)
    for k in range(run):
        total = total * STEP + each[k : k + len(total)]
    return np.unique(mixed(total))


def sketch(found: np.ndarray) -> bytes:
    """Parity of the hashes in each of ``SKETCH_BITS`` or more places, a power of two not under their number: two sets differ in at
    least as many hashes as their sketches in bits."""
    places = max(SKETCH_BITS, 1 << (len(found) - 1).bit_length())
    odd = np.bincount((found & np.uint64(places - 1)).astype(np.int64), minlength=places) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def apart(a: bytes, b: bytes) -> int:
    """Least number of hashes in which the sets of two sketches differ; the longer sketch is folded."""
    x, y = sorted((np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)), key=len)
    y = np.bitwise_xor.reduce(y.reshape(-1, len(x)), axis=0)
    return int(np.bitwise_count(x ^ y).sum())


def _lists(rows: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    values = np.concatenate(rows) if rows else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.view(np.int64)))


def _sets(docs: DataFrame, words: int) -> DataFrame:
    """doc_id and ``set``, the shingles of each row."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                rows = [shingles(t, words) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), _lists(rows)], names=["doc_id", "set"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, set array<long>")


def _added(parts: DataFrame, *by: str) -> DataFrame:
    """Chunks of counters with the same number added up within each partition, one after the other."""

    def run(batches):
        sums = {}
        for batch in batches:
            for chunk, part in zip(batch.column("chunk").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                counts = np.frombuffer(part, np.uint64)
                sums[chunk] = sums[chunk] + counts if chunk in sums else counts
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(sums, pa.int32()), pa.array([0] * len(sums), pa.int32()), pa.array([c.tobytes() for c in sums.values()], pa.binary())],
                names=["chunk", "salt", "counts"])

    return parts.repartition(*by).mapInArrow(run, "chunk int, salt int, counts binary")


def _frequencies(docs: DataFrame, words: int) -> np.ndarray:
    """How common shingles are, by their high bits, on a logarithmic scale of a byte: counts over all documents in a table of
    fixed size, added up in the tasks and then twice over the tasks, so no task holds more than the table."""

    def run(batches):
        counts = np.zeros(1 << COUNTER_BITS, np.uint64)
        task = 0
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                found = [shingles(t, words) for t in batch.column(1).slice(at, ROWS_AT_ONCE).to_pylist()]
                task += sum(map(len, found))
                np.add.at(counts, (np.concatenate(found) >> np.uint64(64 - COUNTER_BITS)).astype(np.int64), np.uint64(1))
        for chunk, part in enumerate(counts.reshape(-1, 1 << CHUNK_BITS)):
            if part.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([chunk], pa.int32()), pa.array([task % SALTS], pa.int32()), pa.array([part.tobytes()], pa.binary())],
                    names=["chunk", "salt", "counts"])

    parts = docs.select("doc_id", "text").mapInArrow(run, "chunk int, salt int, counts binary")
    table = np.zeros((1 << (COUNTER_BITS - CHUNK_BITS), 1 << CHUNK_BITS), np.uint8)
    for r in _added(_added(parts, "chunk", "salt"), "chunk").collect():  # the table, whatever the number of documents
        table[r["chunk"]] = np.minimum(8 * np.log2(1 + np.frombuffer(r["counts"], np.uint64)), 255)
    return table.ravel()


def _nodes(docs: DataFrame, words: int, similarity: float) -> DataFrame:
    """Per row: doc_id, ``high`` and ``low`` (128 bits of the set), ``size``, ``first`` (the shingles one of which every
    set over the bound has among its own first ones), ``sketch`` and ``bits``, the sketch folded to ``SKETCH_BITS``."""
    frequencies = _frequencies(docs, words)

    def run(batches):
        import xxhash

        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                prints, sizes, firsts, sketches = [], [], [], []
                for text in part.column(1).to_pylist():
                    found = shingles(text, words)
                    rank = frequencies[(found >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)]
                    keep = len(found) - math.ceil(similarity * len(found) - EPS) + 1
                    prints.append(np.frombuffer(xxhash.xxh3_128_digest(found.tobytes()), "<i8"))
                    sizes.append(len(found))
                    firsts.append(found[np.argsort(rank, kind="stable")[:keep]])
                    sketches.append(sketch(found))
                both = np.array(prints).reshape(-1, 2)
                folded = [np.bitwise_xor.reduce(np.frombuffer(x, "<u8").reshape(-1, SKETCH_BITS // 64), axis=0) for x in sketches]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(both[:, 0]), pa.array(both[:, 1]), pa.array(sizes, pa.int32()), _lists(firsts),
                     pa.array(sketches, pa.binary()), _lists(folded)],
                    names=["doc_id", "high", "low", "size", "first", "sketch", "bits"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, high long, low long, size int, first array<long>, sketch binary, bits array<long>")


def _near(pairs: DataFrame, nodes: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) that lengths and sketches do not rule out."""
    sides = [nodes.select(F.col("id").alias(k), F.col("size").alias(f"size_{k}"), F.col("sketch").alias(f"sketch_{k}")) for k in "ab"]
    both = pairs.join(sides[0], "a").join(sides[1], "b").select("a", "b", "size_a", "size_b", "sketch_a", "sketch_b")
    most = (1 - similarity) / (1 + similarity)

    def run(batches):
        for batch in batches:
            a, b, m, n, x, y = (c.to_pylist() for c in batch.columns)
            good = [apart(p, q) <= most * (k + j) + EPS for k, j, p, q in zip(m, n, x, y, strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return both.mapInArrow(run, "a long, b long").distinct()


def similar_links(docs: DataFrame, pairs: DataFrame, words: int, similarity: float) -> DataFrame:
    """The ``pairs`` (a, b) of keys whose texts' sets of shingles have a Jaccard index of at least ``similarity``. Sets are
    made only of texts that are in a pair."""
    asked = pairs.select("a").union(pairs.select("b")).distinct().withColumnRenamed("a", "doc_id")
    with text_batches(docs.sparkSession):
        sets = written(_sets(docs.join(asked, "doc_id", "left_semi"), words))
    left, right = (sets.select(F.col("doc_id").alias(k), F.col("set").alias(f"set_{k}")) for k in ("a", "b"))
    both = pairs.join(left, "a").join(right, "b")
    common = F.size(F.array_intersect("set_a", "set_b"))
    return both.where(common >= similarity * (F.size("set_a") + F.size("set_b") - common)).select("a", "b").distinct()


def links(docs: DataFrame, nodes: DataFrame, words: int, similarity: float, nearest: DataFrame | None = None) -> DataFrame:
    """Links (a, b) between ``id`` of rows of ``nodes`` (id, size, first, sketch, bits; each set once) that join all, and only,
    what pairs of at least ``similarity`` join. Pairs (a, b) of ``nearest`` are tested first."""
    share, most = similarity / (1 + similarity), (1 - similarity) / (1 + similarity)

    def may(i, m, j, n):
        """Whether sets of m and n shingles that first meet at places i and j of their orders can be over the bound."""
        return ((F.least(m, n) + EPS >= similarity * F.greatest(m, n))
                & (F.least(m - i, n - j) + EPS >= share * (m + n)))

    held = nodes.select("id", "size", F.posexplode("first").alias("place", "token"))
    one = Window.partitionBy("token")
    held = held.withColumns({"n": F.count("*").over(one), "lead": F.min(F.struct("place", "id", "size")).over(one)})
    held = written(held.where("n > 1").select("token", "id", "size", "place", "lead"))

    def tested(a: DataFrame) -> DataFrame:
        a = a.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        return written(similar_links(docs, written(_near(a, nodes, similarity)), words, similarity))

    stars = held.where(may(F.col("place"), F.col("size"), F.col("lead.place"), F.col("lead.size")))
    stars = stars.select(F.col("id").alias("a"), F.col("lead.id").alias("b")).where("a != b").distinct()
    if nearest is None:
        found = tested(stars)
    else:
        found = tested(nearest)
        joined = components(found)
        for k in "ab":
            stars = stars.join(joined.select(F.col("node").alias(k), F.col("component").alias(f"group_{k}")), k, "left")
        apart_yet = F.coalesce("group_a", "a") != F.coalesce("group_b", "b")
        found = found.union(tested(stars.where(apart_yet).select("a", "b")))
    joined = components(found)
    named = held.join(joined, held["id"] == joined["node"], "left").select(
        "token", "id", "size", "place", F.col("lead.id").alias("lead"), F.coalesce("component", "id").alias("group"))
    main = F.min(F.when(F.col("id") == F.col("lead"), F.col("group"))).over(one)
    named = named.withColumn("main", main)
    named = written(named.withColumn("rest", F.max(F.when(F.col("group") != F.col("main"), 1)).over(one)).where("rest = 1").drop("rest"))
    # sketches in the join itself: sets that only meet at a shingle make no row
    named = written(named.join(nodes.select("id", "bits"), "id"))
    a, b = named.where("group != main").alias("x"), named.where("id != lead").alias("y")
    c = {f"{s}{k}": F.col(f"{s}.{k}") for s in "xy" for k in ("token", "id", "size", "place", "group", "main", "bits")}
    differ = reduce(add, (F.bit_count(c["xbits"][k].bitwiseXOR(c["ybits"][k])) for k in range(SKETCH_BITS // 64)))
    others = a.join(b, (c["xtoken"] == c["ytoken"]) & (c["xgroup"] != c["ygroup"])
                    & ((c["ygroup"] == c["ymain"]) | (c["xid"] < c["yid"]))
                    & may(c["xplace"], c["xsize"], c["yplace"], c["ysize"])
                    & (differ <= most * (c["xsize"] + c["ysize"]) + EPS))
    return found.union(tested(others.select(c["xid"].alias("a"), c["yid"].alias("b"))))


def group(docs: DataFrame, words: int, similarity: float, nearest: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id and component_id, the smallest doc_id that links reach. ``nearest`` gives
    pairs (a, b) of the keys (doc_id) of the texts that stand for a set; they are tested before all others.

    Texts with one set are one node, named by its smallest key; rows with a null key have the component of their set's other
    rows, null if none has a key.
    """
    docs = docs.select("doc_id", "text")
    with text_batches(docs.sparkSession):
        rows = written(_nodes(docs, words, similarity))
    one = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "size")))
    named = rows.groupBy("high", "low").agg(one.alias("m")).where("m IS NOT NULL")
    named = written(named.select("high", "low", F.col("m.doc_id").alias("id")))
    nodes = rows.join(named, (rows["doc_id"] == named["id"]) & (rows["high"] == named["high"]) & (rows["low"] == named["low"]))
    nodes = nodes.select("id", rows["high"], rows["low"], "size", "first", "sketch", "bits")
    nodes = written(nodes.dropDuplicates(["id", "high", "low"]))
    pairs = nearest(nodes.select(F.col("id").alias("doc_id")).distinct()) if nearest else None
    joined = components(links(docs, nodes, words, similarity, pairs))
    reached = named.join(joined, named["id"] == joined["node"], "left").select("high", "low", F.coalesce("component", "id").alias("component"))
    return rows.select("doc_id", "high", "low").join(reached, ["high", "low"], "left").select(
        "doc_id", F.col("component").alias("component_id"))
