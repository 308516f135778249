"""Resharding with the fewest moved bytes: a minimum-cost flow from old shard sizes to new capacities.

The flow is solved over shards only. Within an old shard the rows stand in blocks; a block's place among the shard's bytes
decides where it goes, and only blocks that a boundary cuts are looked at row by row, without their texts.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from offerforge.llm.frames import put_back, set_aside
from offerforge.session import written

BLOCK_BYTES = 8 << 20
MOST_BLOCKS = 50_000
"""Blocks of all shards together; beyond it they grow. Their table is broadcast, one row of a few numbers each."""


def min_cost_flow(supply: list[int], capacity: list[int], cost: list[list[int]] | None = None) -> list[list[int]]:
    """Bytes from each old to each new shard, all supply placed, at least total cost.

    ``cost`` of a byte defaults to 0 where it stays (same number) and 1 where it moves. Each round sends as much as fits
    along a cheapest path of what is left (Dijkstra over reduced costs).
    """
    n, m = len(supply), len(capacity)
    if sum(supply) > sum(capacity):
        raise ValueError("the new shards hold less than there is")
    cost = cost or [[int(i != j) for j in range(m)] for i in range(n)]
    flow = [[0] * m for _ in range(n)]
    left, room = list(supply), list(capacity)
    height = [0] * n + [min((cost[i][j] for i in range(n)), default=0) for j in range(m)]
    height.append(min(height[n:], default=0))
    end = n + m  # every new shard with room leads there for nothing
    for source in range(n):
        while left[source]:
            far: list[float] = [float("inf")] * (end + 1)
            came = [-1] * (end + 1)
            far[source] = 0
            work = [(0, -source)]
            done = set()
            while work:
                d, x = heapq.heappop(work)
                x = -x
                if x in done:
                    continue
                done.add(x)
                if x == end:
                    break
                if x < n:
                    steps = [(n + j, cost[x][j]) for j in range(m)]
                else:
                    steps = [(i, -cost[i][x - n]) for i in range(n) if flow[i][x - n]] + [(end, 0)] * bool(room[x - n])
                for y, c in steps:
                    new = d + c + height[x] - height[y]
                    if new < far[y]:
                        far[y], came[y] = new, x
                        heapq.heappush(work, (new, -y))  # the end first among equals
            for x in range(end + 1):
                height[x] += far[x] if x in done else far[end]
            goal = came[end]
            path, x = [], goal
            while x != source:
                path.append((came[x], x))
                x = came[x]
            sent = min([left[source], room[goal - n]] + [flow[y][x - n] for x, y in path if x >= n])
            for x, y in path:
                if x < n:
                    flow[x][y - n] += sent
                else:
                    flow[y][x - n] -= sent
            left[source] -= sent
            room[goal - n] -= sent
    return flow


def even_capacities(total: int, shards: int) -> list[int]:
    """Sizes that differ by at most one byte."""
    return [total // shards + (k < total % shards) for k in range(shards)]


def row_bytes(text: str) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def plan(docs: DataFrame, old: Column, capacities: list[int] | int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``_old`` and ``shard`` (int): where each row is and where it goes.

    ``old`` numbers the old shards from 0. ``capacities`` lists the new shards' bytes, or is their number, for even ones.
    A row's size is its UTF-8 bytes and one more; a row belongs where its first byte falls, so a shard holds its capacity
    to within the rows at its ends. Staying bytes come first in an old shard's order, the order is by block, key and text
    hash. Null texts count one byte, null keys are placed like others, rows alike in key and text go the same way. No rows
    give no rows. Columns ``shard`` and ``_old`` of ``docs`` are replaced, whatever the case of their letters. ``docs`` is
    read twice: once for keys, sizes and hashes, which decide on the places, and once for the result, whose rows find
    their shard in a table of the blocks; texts are not shuffled here.
    """
    spark = docs.sparkSession
    own, names = set_aside(docs.withColumn("__the_old_shard", old.cast("int")))
    number = names.pop("__the_old_shard")
    key, text = names[key], names[text]
    rows = own.withColumns({"_old": F.col(number), "_tie": F.xxhash64(key, text)})
    narrow = written(rows.select("_old", F.col(key).alias("_key"), "_tie", row_bytes(text).alias("_size")))
    sizes = {r["_old"]: r["n"] for r in narrow.groupBy("_old").agg(F.sum("_size").alias("n")).collect()}
    total = sum(sizes.values())
    if isinstance(capacities, int):
        capacities = even_capacities(total, capacities)
    supply = [sizes.get(k, 0) for k in range(max(sizes, default=-1) + 1)]
    moves = []
    for i, out in enumerate(min_cost_flow(supply, capacities)):
        at = 0
        for j in sorted(range(len(out)), key=lambda j, i=i: (j != i, j)):
            if out[j]:
                moves.append((i, j, at, at + out[j]))
                at += out[j]
    flows = F.broadcast(spark.createDataFrame(moves, "_old int, _to int, _low long, _high long"))  # at most old times new shards

    blocks = max(1, min(total // BLOCK_BYTES, MOST_BLOCKS) // max(1, len(supply)))
    block = F.pmod("_tie", F.lit(blocks)).alias("_block")
    narrow = narrow.select("*", block)
    summed = written(narrow.groupBy("_old", "_block").agg(F.sum("_size").alias("_bytes")))
    before = Window.partitionBy("_old").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    summed = summed.withColumn("_at", F.coalesce(F.sum("_bytes").over(before), F.lit(0)))
    placed = summed.join(flows, "_old").where("_low < _at + _bytes AND _high > _at")
    placed = written(placed.groupBy("_old", "_block").agg(
        F.first("_at").alias("_at"), F.when(F.count("*") == 1, F.first("_to")).alias("_to")))
    # a boundary cuts few blocks; only their rows are put in order, and give the first row of every part
    cut = narrow.join(F.broadcast(placed.where("_to IS NULL").drop("_to")), ["_old", "_block"])
    within = Window.partitionBy("_old", "_block").orderBy("_key", "_tie").rowsBetween(Window.unboundedPreceding, -1)
    cut = cut.withColumn("_at", F.col("_at") + F.coalesce(F.sum("_size").over(within), F.lit(0)))
    cut = cut.join(flows, "_old").where("_at >= _low AND _at < _high")
    starts = cut.groupBy("_old", "_block", "_to").agg(F.min(F.struct("_key", "_tie")).alias("_first"))
    starts = starts.groupBy("_old", "_block").agg(F.sort_array(F.collect_list(F.struct("_first", F.col("_to").alias("_part")))).alias("_parts"))
    found = written(placed.select("_old", "_block", "_to").join(starts, ["_old", "_block"], "left"))  # at most MOST_BLOCKS rows

    rows = rows.select("*", block).join(F.broadcast(found), ["_old", "_block"])
    here = F.struct(F.col(key).alias("_key"), "_tie")
    part = F.element_at(F.filter("_parts", lambda p: p["_first"] <= here), -1)["_part"]
    return rows.select(*put_back(names, "_old", "shard"), "_old", F.coalesce("_to", part).alias("shard"))


def rewrite(planned: DataFrame, path: str, affected_only: bool = False) -> None:
    """Writes the shards as folders of Parquet files under ``path``; with ``affected_only`` just those that gain or lose
    rows. The rows of a shard are spread over tasks and files of a size that Spark keeps even."""
    if affected_only:
        moved = planned.where("_old != shard").select(F.explode(F.array("_old", "shard")).alias("shard")).distinct()
        planned = planned.join(F.broadcast(moved), "shard", "left_semi")  # as many rows as there are shards
    planned.drop("_old").hint("rebalance", "shard").write.partitionBy("shard").parquet(path)


def read_back(spark: SparkSession, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32 (null text as empty), shard and slot of every row, all from the files.

    The slot is the row's place in its file after the rows of the shard's earlier files, in order of their names.
    """
    files = spark.read.parquet(path)
    at = {"_file": F.col("_metadata.file_name"), "_row": F.col("_metadata.row_index")}
    rows = files.select(
        F.col(key).alias("doc_id"), row_bytes(text).alias("size"), F.col("shard").cast("int").alias("shard"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"), *(c.alias(n) for n, c in at.items()))
    counts = files.select("shard", at["_file"].alias("_file")).groupBy("shard", "_file").count()
    before = Window.partitionBy("shard").orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(F.col("shard").cast("int").alias("shard"), "_file",
                           F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    return rows.join(counts, ["shard", "_file"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("_before") + F.col("_row")).alias("slot"))
