"""Ranked lexical search over bit-sliced Bloom signatures.

The index holds blocks of documents of like size. A document's signature gets ``HASHES`` bits for each of its terms, and
again for each level (2, 4 or 8 occurrences) that the term reaches. A block keeps signatures transposed: one bitmap over
its documents per signature bit. For a query term the bitmaps of its bits, and'ed, overestimate where it occurs and how
often. Weighted sums of these bitmaps, with the score that so many occurrences give at most in a document of that length,
bound every score from above. Documents are rescored exactly in falling order of their bounds until the bound is below
the k-th best exact score found so far; the others are provably out. Tasks give their best k, of which the best k are kept.

Documents without a term (null and empty texts too) are not counted and never found. Queries without a term give no
rows. Equal rows of the queries count once; rows of one key with different texts are queries of their own. Repeated
documents are all ranked, ties by ascending key, null last. Empty tables give no rows. Other columns take no part.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from offerforge.llm.frames import arrow_schema
from offerforge.session import BROADCAST_ROWS, scratch_path

# Fixed values of the contract: results per query and the score's constants.
BEST = 10
SCALE, LENGTH_FACTOR = 1_000_000_000, 8
BASE, SHARE = 25, 75

LEVELS = (1, 2, 4, 8)
"""Occurrences from which a term is entered once more."""
HASHES = 3
BITS = 8
"""Signature bits per entry, before the size is rounded up to a power of two."""
LEAST_ENTRIES = 64
BLOCK_BYTES, BLOCK_DOCS, BLOCK_CELLS = 2 << 20, 1024, 16 << 20
"""A block ends at so many bytes of text, documents, or bits of its matrix."""
TERMS_AT_ONCE = 200_000
"""Terms counted in a task before the counts are handed on."""
QUERY_BYTES = 4 << 20
"""Bytes of query text in one pass over the index."""

_LOWER = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256)
)
"""ASCII: digits and letters, lower-cased; the rest parts terms. Bytes of other characters stay."""


def terms(text: bytes) -> list[bytes]:
    return text.translate(_LOWER).split()


class _Vocabulary(dict):
    """Number of each term seen in a task; its digest and document count stand under that number."""

    def __init__(self) -> None:
        self.digests = np.zeros(1 << 14, np.uint64)
        self.df = np.zeros(1 << 14, np.int64)

    def __missing__(self, term: bytes) -> int:
        number = len(self)
        if number == len(self.df):
            self.digests = np.concatenate([self.digests, np.zeros_like(self.digests)])
            self.df = np.concatenate([self.df, np.zeros_like(self.df)])
        self.digests[number] = digest(term)
        self[term] = number
        return number


def digest(term: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(term)


def signature_rows(digests: np.ndarray, level: int, width: int) -> np.ndarray:
    """Signature bits of each term at a level: an array of ``HASHES`` columns."""
    mixed = (digests + np.uint64(level * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) * np.uint64(0xD6E8FEB86659FD93)
    first, step = mixed >> np.uint64(32), (mixed & np.uint64(0xFFFFFFFF)) | np.uint64(1)
    return np.stack([(first + np.uint64(i) * step) % np.uint64(width) for i in range(HASHES)], axis=1).astype(np.int64)


class _Block:
    def __init__(self, width: int) -> None:
        self.width, self.keys, self.lengths, self.texts, self.bits, self.size = width, [], [], [], [], 0

    def add(self, key, length: int, text: bytes, bits: np.ndarray) -> None:
        self.keys.append(key)
        self.lengths.append(length)
        self.texts.append(text)
        self.bits.append(bits)
        self.size += len(text)

    def full(self) -> bool:
        n = len(self.keys)
        return self.size >= BLOCK_BYTES or n >= BLOCK_DOCS or (n + 8) * self.width > BLOCK_CELLS

    def slices(self) -> bytes:
        matrix = np.zeros((self.width, len(self.keys)), np.uint8)
        for place, bits in enumerate(self.bits):
            matrix[bits, place] = 1
        return np.packbits(matrix, axis=1).tobytes()


def build_index(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> None:
    """Writes the blocks and the document counts of all terms to ``path``, reading the texts once."""
    kind = docs.schema[key].dataType.simpleString()
    schema = f"term string, df long, width long, keys array<{kind}>, lengths array<long>, slices binary, texts array<binary>"
    arrow = arrow_schema(docs.sparkSession, schema)

    def batch(rows: dict, n: int) -> pa.RecordBatch:
        columns = [pa.array(rows[f.name], f.type) if f.name in rows else pa.nulls(n, f.type) for f in arrow]
        return pa.RecordBatch.from_arrays(columns, schema=arrow)

    def counted(vocabulary: _Vocabulary) -> Iterator[pa.RecordBatch]:
        names = iter(vocabulary)
        for at in range(0, len(vocabulary), 10_000):
            part = [t.decode() for t in islice(names, 10_000)]
            yield batch({"term": part, "df": vocabulary.df[at : at + len(part)]}, len(part))

    def block_row(block: _Block) -> pa.RecordBatch:
        return batch({"width": [block.width], "keys": [block.keys], "lengths": [block.lengths],
                      "slices": [block.slices()], "texts": [block.texts]}, 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[int, _Block] = {}
        vocabulary = _Vocabulary()
        for rows in batches:
            texts = rows.column(1).cast(pa.binary())
            for own_key, raw in zip(rows.column(0), texts):
                raw = raw.as_py()
                found = Counter(terms(raw))
                if not found:
                    continue
                numbers = np.fromiter(map(vocabulary.__getitem__, found), np.int64, len(found))
                times = np.fromiter(found.values(), np.int64, len(found))
                vocabulary.df[numbers] += 1
                digests = vocabulary.digests[numbers]
                entered = [digests[times >= least] for least in LEVELS]
                entries = sum(map(len, entered))
                width = BITS * max(LEAST_ENTRIES, 1 << (entries - 1).bit_length())
                bits = np.concatenate([signature_rows(d, level, width).ravel() for level, d in enumerate(entered)]).astype(np.int32)
                block = blocks.setdefault(width, _Block(width))
                block.add(own_key.as_py(), int(times.sum()), raw, bits)
                if block.full():
                    yield block_row(blocks.pop(width))
                if len(vocabulary) >= TERMS_AT_ONCE:
                    yield from counted(vocabulary)
                    vocabulary = _Vocabulary()
        for block in blocks.values():
            yield block_row(block)
        yield from counted(vocabulary)

    own = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).where("text IS NOT NULL")
    # rows are large, so that row groups have to be checked often to stay small
    writer = own.mapInArrow(run, schema).write.option("parquet.block.size", 32 << 20)
    writer.option("parquet.block.size.row.check.min", 1).option("parquet.block.size.row.check.max", 10).parquet(path)


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def norm(length: int, n_docs: int, all_terms: int) -> int:
    return BASE + (SHARE * length * n_docs) // all_terms


def part_score(times: int, norm_: int) -> int:
    return (SCALE * times) // (1000 * times + LENGTH_FACTOR * norm_)


class _Queries:
    """A bounded set of queries: per query its terms, by number, with weight times occurrences."""

    def __init__(self, texts: list[bytes], weights: dict[bytes, int]) -> None:
        numbers: dict[bytes, int] = {}
        self.terms: list[list[tuple[bytes, int]]] = []
        self.places: list[np.ndarray] = []
        self.weights: list[np.ndarray] = []
        for text in texts:
            own = [(t, n * weights[t]) for t, n in Counter(terms(text)).items() if weights.get(t, 0) > 0]
            self.terms.append(own)
            self.places.append(np.array([numbers.setdefault(t, len(numbers)) for t, _ in own], np.int64))
            self.weights.append(np.array([w for _, w in own], np.float64))
        self.digests = np.fromiter((digest(t) for t in numbers), np.uint64, len(numbers))


class _Best:
    """The best of one query in one task; a document that ties with the last of them is kept too."""

    def __init__(self, k: int) -> None:
        self.k, self.heap, self.found = k, [], []

    def least(self) -> int:
        """Scores below this one are out."""
        return self.heap[0] if len(self.heap) == self.k else 1

    def add(self, score: int, key) -> None:
        if score < self.least():
            return
        if len(self.heap) < self.k:
            heapq.heappush(self.heap, score)
        else:
            heapq.heappushpop(self.heap, score)
        self.found.append((score, key))
        if len(self.found) > 4096:
            self.cut()

    def cut(self) -> None:
        """The k best by score and key; of ties those with the smallest keys, null last."""
        self.found.sort(key=lambda f: (-f[0], f[1] is None, f[1]))
        del self.found[self.k :]


def _bounds(queries: _Queries, width: int, slices: bytes, n: int, norms: list[int], lengths: list[int]) -> Iterator[np.ndarray]:
    """For each query the upper bounds of all documents of a block; all numbers are whole and far below 2^53."""
    matrix = np.frombuffer(slices, np.uint8).reshape(width, -1)
    present, steps, below = [], [], np.zeros(n)
    packed = None
    for level in range(len(LEVELS)):
        rows = signature_rows(queries.digests, level, width)
        found = matrix[rows[:, 0]]
        for i in range(1, HASHES):
            found &= matrix[rows[:, i]]
        packed = found if packed is None else found & packed
        present.append(np.unpackbits(packed, axis=1, count=n))
        most = [LEVELS[level + 1] - 1] * n if level + 1 < len(LEVELS) else lengths
        top = np.array([part_score(max(t, 1), m) for t, m in zip(most, norms)], np.float64)
        top = np.maximum(top, below)
        steps.append(top - below)
        below = top
    hits = [p.any(axis=1) for p in present]
    for places, weights in zip(queries.places, queries.weights):
        bound = np.zeros(n)
        for bits, some, step in zip(present, hits, steps):
            inside = some[places]
            if not inside.any():
                break
            bound += step * (weights[inside] @ bits[places[inside]])
        yield bound


def _best_of_blocks(queries: _Queries, n_docs: int, all_terms: int, k: int, batches: Iterator[pa.RecordBatch]) -> list[_Best]:
    best = [_Best(k) for _ in queries.terms]
    for batch in batches:
        for row in range(batch.num_rows):
            width, keys, lengths, slices = (batch.column(i)[row].as_py() for i in range(4))
            texts = batch.column(4)[row].values
            norms = [norm(length, n_docs, all_terms) for length in lengths]
            counts: dict[int, Counter] = {}
            bounds = _bounds(queries, width, slices, len(keys), norms, lengths)
            for own, kept, bound in zip(queries.terms, best, bounds):
                able = np.flatnonzero(bound >= kept.least())
                for place in able[np.argsort(-bound[able], kind="stable")].tolist():
                    if bound[place] < kept.least():
                        break
                    if place not in counts:
                        counts[place] = Counter(terms(texts[place].as_py()))
                    held, m = counts[place], norms[place]
                    score = sum(w * part_score(held[t], m) for t, w in own if t in held)
                    kept.add(score, keys[place])
    return best


def search(
    spark: SparkSession, path: str, items: DataFrame, key: str = "item_id", text: str = "text", k: int = BEST,
    query_bytes: int = QUERY_BYTES,
) -> DataFrame:
    """``key``, ``rank``, ``doc_id``, ``score``: the ``k`` best documents of every query, from the index at ``path``.

    Queries are taken in passes of about ``query_bytes`` of text by hash; only those of one pass and the document
    counts of their terms are held by driver and tasks.
    """
    index = spark.read.parquet(path)
    blocks = index.where("slices IS NOT NULL").select("width", "keys", "lengths", "slices", "texts")
    total = F.aggregate("lengths", F.lit(0).cast("long"), lambda a, n: a + n)
    n_docs, all_terms = index.where("lengths IS NOT NULL").agg(F.sum(F.size("lengths")), F.sum(total)).first()
    asked = items.select(F.col(key).alias("item"), F.col(text).alias("text")).where("text IS NOT NULL").distinct()
    asked = asked.withColumn("_part", F.xxhash64("item", "text"))
    passes = (asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // query_bytes + 1

    doc_key = index.schema["keys"].dataType.elementType.simpleString()
    empty = spark.range(0).select(
        *[F.lit(None).cast(t).alias(n) for n, t in (("item", asked.schema["item"].dataType), ("query", "string"),
                                                    ("doc_id", doc_key), ("score", "long"))])
    found = [empty]
    for number in range(passes):
        some = asked.where(F.pmod("_part", F.lit(passes)) == number).drop("_part").collect()
        names = sorted({t.decode() for r in some for t in terms(r.text.encode())})
        if not names or not n_docs:
            continue
        wanted = spark.createDataFrame([(t,) for t in names], "term string")
        wanted = F.broadcast(wanted) if len(names) <= BROADCAST_ROWS else wanted
        counts = index.where("term IS NOT NULL").select("term", "df").join(wanted, "term").groupBy("term").agg(F.sum("df"))
        weights = {t.encode(): term_weight(n_docs, df) for t, df in counts.collect()}
        found.append(_searched(blocks, some, weights, n_docs, all_terms, k, doc_key, empty))
    whole = found[0]
    for part in found[1:]:
        whole = whole.unionByName(part)
    order = Window.partitionBy("item", "query").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    ranked = whole.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select(F.col("item").alias(key), "rank", "doc_id", "score")


def _searched(
    blocks: DataFrame, some: list, weights: dict[bytes, int], n_docs: int, all_terms: int, k: int, doc_key: str, like: DataFrame
) -> DataFrame:
    """The best ``k`` of every task for the queries of one pass."""
    spark = blocks.sparkSession
    held = spark.sparkContext.broadcast(_Queries([r.text.encode() for r in some], weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from_tasks = _best_of_blocks(held.value, n_docs, all_terms, k, batches)
        rows = []
        for place, best in enumerate(from_tasks):
            best.cut()
            rows += [(place, doc, score) for score, doc in best.found]
        if rows:
            places, docs, scores = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(places, pa.int64()), pa.array(docs, kind), pa.array(scores, pa.int64())], names=["place", "doc_id", "score"])

    schema = f"place long, doc_id {doc_key}, score long"
    kind = arrow_schema(spark, schema).field("doc_id").type
    best = blocks.mapInArrow(run, schema)
    listed = [(place, r.item, r.text) for place, r in enumerate(some)]
    queries = spark.createDataFrame(listed, f"place long, item {like.schema['item'].dataType.simpleString()}, query string")
    return best.join(F.broadcast(queries), "place").select("item", "query", "doc_id", "score")


def ranked_search(items: DataFrame, docs: DataFrame, k: int = BEST) -> DataFrame:
    """Builds the index of ``docs`` in the shared folder and searches it for every item."""
    spark = docs.sparkSession
    path = scratch_path(spark, "signatures")
    build_index(docs, path)
    return search(spark, path, items, k=k)
