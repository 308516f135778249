"""Packs tokenised documents into as few sequences as possible by best fit with large-item matching.

The plan is made from the count of pieces of each length, which has at most ``capacity`` entries whatever the corpus, and
says which ranks of a length go to which sequences. The pieces get their ranks from Spark and look their place up.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from offerforge.llm.encoder import encoder, release
from offerforge.llm.frames import arrow_schema, map_rows, put_back, set_aside, texts
from offerforge.session import text_batches, written

CAPACITY = 4096
END_ID = 1
PIECES_A_BUCKET = 20_000


def plan(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int, int]], int]:
    """Segments (length, first_rank, last_rank, first_sequence, each, offset) and the number of sequences.

    A segment puts ``each`` pieces of a length into every sequence from ``first_sequence`` on, from ``offset`` on.
    Pieces above a third of the capacity pair at most twice in a sequence: from the longest down, one above a half
    takes the longest partner of at most a half that fits, which gives the most pairs, as a shorter one fits wherever a
    longer one does. The partners left pair with each other. Smaller pieces, longest first, go where the least room
    is left that holds them; a sequence that has taken one has the least room, so it takes as many as fit.
    """
    segments, sequences = [], 0
    ranks: dict[int, int] = {}
    rooms: dict[int, list[tuple[int, int]]] = {}  # room left: ranges (first sequence, count)
    order: list[int] = []  # the rooms in order

    def put(length: int, n: int, first: int, each: int, offset: int) -> None:
        at = ranks.get(length, 0)
        segments.append((length, at, at + n - 1, first, each, offset))
        ranks[length] = at + n

    def leave(room: int, first: int, count: int) -> None:
        if room and count:
            if room not in rooms:
                rooms[room] = []
                insort(order, room)
            rooms[room].append((first, count))

    left = {k: n for k, n in counts.items() if 3 * k > capacity and n}
    partners = sorted(k for k in left if 2 * k <= capacity)
    for big in sorted((k for k in left if 2 * k > capacity), reverse=True):
        while left[big]:
            at = bisect_right(partners, capacity - big)
            small = partners[at - 1] if at else 0
            n = min(left[big], left[small]) if small else left[big]
            put(big, n, sequences, 1, 0)
            if small:
                put(small, n, sequences, 1, big)
                left[small] -= n
                if not left[small]:
                    partners.pop(at - 1)
            leave(capacity - big - small, sequences, n)
            left[big] -= n
            sequences += n
    waiting = 0  # the length of a piece alone in the last sequence
    for k in reversed(partners):
        n = left[k]
        if waiting:
            put(k, 1, sequences - 1, 1, waiting)
            leave(capacity - waiting - k, sequences - 1, 1)
            n, waiting = n - 1, 0
        if n // 2:
            put(k, n // 2 * 2, sequences, 2, 0)
            leave(capacity - 2 * k, sequences, n // 2)
            sequences += n // 2
        if n % 2:
            put(k, 1, sequences, 1, 0)
            sequences, waiting = sequences + 1, k
    if waiting:
        leave(capacity - waiting, sequences - 1, 1)

    for k in sorted((k for k, n in counts.items() if 3 * k <= capacity and n), reverse=True):
        n = counts[k]
        while n:
            at = bisect_left(order, k)
            if at == len(order):
                room, each = capacity, capacity // k
                count = -(-n // each)
                first, sequences = sequences, sequences + count
            else:
                room = order[at]
                each = room // k
                first, count = rooms[room].pop()
                if not rooms[room]:
                    del rooms[room], order[at]
            full = min(count, n // each)
            if full:
                put(k, full * each, first, each, capacity - room)
                leave(room - each * k, first, full)
                n -= full * each
            if full < count and n:  # fewer than one sequence takes
                put(k, n, first + full, each, capacity - room)
                leave(room - n * k, first + full, 1)
                full, n = full + 1, 0
            leave(room, first + full, count - full)
    return segments, sequences


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, keep_ids: bool = True,
           key: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces of at most ``capacity`` ids: doc_id, piece, start, length, ids_crc32 and, if asked, ids.

    A document is the ids of its whole text and the end id. A null or empty text is the end id alone. Only documents
    longer than the capacity are cut. A null key stays null; repeated rows each give their pieces.
    """
    kinds = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if keep_ids else "")
    end, step = end_id.to_bytes(4, "little"), 4 * capacity

    def make(batch):
        import numpy as np

        rows, encode = [], encoder(tokenizer).ids
        for doc, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            ids = encode(body) + end
            for n, at in enumerate(range(0, len(ids), step)):
                part = ids[at : at + step]
                row = {"doc_id": doc, "piece": n, "start": at // 4, "length": len(part) // 4, "ids_crc32": zlib.crc32(part)}
                rows.append(row | {"ids": np.frombuffer(part, "<u4").tolist()} if keep_ids else row)
        return rows

    return map_rows(texts(docs, key, text, "doc_id"), make, kinds, release)


def pack(cut: DataFrame, capacity: int = CAPACITY, order: tuple[str, ...] = ("doc_id", "piece", "ids_crc32")) -> DataFrame:
    """``cut`` with ``sequence_id`` and ``offset`` (both long) for each row's ``length`` of 1 to ``capacity``.

    ``cut`` is read twice, so it should be a written table. Rows of one length are numbered in buckets by a hash of the
    ``order`` columns and the buckets' counts are added up, so no length goes to one task, however many rows have it.
    Rows alike in all ``order`` columns may change places, which changes nothing. Other columns are kept, but for
    ``sequence_id`` and ``offset``, which are replaced. No rows give no rows.
    """
    spark = cut.sparkSession
    own, names = set_aside(cut)
    order = [names[c] for c in order]
    numbered = own.withColumns({"_n": F.xxhash64(*order), "length": F.col(names["length"])})
    total = cut.count()
    buckets = max(8, total // PIECES_A_BUCKET)
    numbered = numbered.withColumn("_bucket", F.pmod("_n", F.lit(buckets)))
    sizes = written(numbered.groupBy("length", "_bucket").agg(F.count("*").alias("_count")))
    counts = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("_count").alias("n")).collect()}
    if counts and not (1 <= min(counts) and max(counts) <= capacity):
        raise ValueError(f"lengths must be between 1 and {capacity}")
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("length", "_bucket", F.coalesce(F.sum("_count").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy("length", "_bucket").orderBy(*order)
    numbered = numbered.withColumn("_rank", F.row_number().over(within) - 1)
    numbered = numbered.join(sizes, ["length", "_bucket"]).withColumn("_rank", F.col("_rank") + F.col("_before"))
    segments, _ = plan(counts, capacity)
    # as an Arrow table: rows of Python objects would start Python workers on the executors to pickle them anew
    kinds = arrow_schema(spark, "_length long, _first long, _last long, _sequence long, _each long, _offset long")
    columns = [pa.array([s[k] for s in segments], kind) for k, kind in enumerate(kinds.types)]
    places = spark.createDataFrame(pa.Table.from_arrays(columns, schema=kinds)).groupBy("_length").agg(F.sort_array(F.collect_list(
        F.struct("_first", "_last", "_sequence", "_each", "_offset"))).alias("_places"))
    # one row for each length, its segments bounded by the capacity
    found = numbered.join(F.broadcast(places), F.col("length") == F.col("_length"))
    at = F.filter("_places", lambda s: (F.col("_rank") >= s["_first"]) & (F.col("_rank") <= s["_last"]))[0]
    found = found.withColumn("_at", at).withColumn("_step", F.col("_rank") - F.col("_at._first"))
    return found.select(
        *put_back(names, "sequence_id", "offset"),
        (F.col("_at._sequence") + F.floor(F.col("_step") / F.col("_at._each"))).cast("long").alias("sequence_id"),
        (F.col("_at._offset") + F.pmod("_step", "_at._each") * F.col("length")).cast("long").alias("offset"),
    )


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, keep_ids: bool = True,
                   key: str = "doc_id", text: str = "text") -> DataFrame:
    """Cuts, writes the pieces once to the shared folder and packs them; see ``pieces`` and ``pack``."""
    with text_batches(docs.sparkSession):
        cut = written(pieces(docs, tokenizer, capacity, end_id, keep_ids, key, text))
    return pack(cut, capacity)
