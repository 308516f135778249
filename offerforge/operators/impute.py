"""Missing-value imputation from exact nearest neighbours.

The search never compares every incomplete row with every complete one. Complete rows (donors) are put into the cells
of a grid whose edges are quantiles, so cells are fine where rows are dense. A wide coordinate is cut more often than a
narrow one, so that cells are about as long as they are broad. Cells are summarised level by level with their bounds. The incomplete rows descend the levels and keep only cells that can hold one of their k nearest donors;
the rest is excluded by the bounds, so the result is exact. Only at the last level do they meet the donors themselves.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from offerforge.functions.names import numeric_columns
from offerforge.operators.encode import fit_labels
from offerforge.operators.entropy import DEPTH, tree_importances
from offerforge.operators.numeric import correlations, fit_stats, with_range_number
from offerforge.operators.tables import lookup_join
from offerforge.session import shared_folder, written

# Neighbours and correlated columns for numbers; neighbours and features for categories.
NUMERIC_NEIGHBOURS = 2
CORRELATED_COLUMNS = 5
CATEGORY_NEIGHBOURS = 7
CATEGORY_FEATURES = 3

START_CELLS = 256
DONORS_PER_CELL = 64
MAX_BITS = 10
CHILD_BITS = 4
MAX_LAG = 20
MAX_CUT = 40


def _bins(d: int) -> list[str]:
    return [f"_b{i}" for i in range(d)]


def _numbered(donors: DataFrame, point: str, name: str, marks: Sequence[float], bits: int) -> DataFrame:
    """Cell number of ``bits`` bits along one coordinate: by quantiles, then in equal parts between two quantiles.

    The numbers only have to rise with the coordinate, as cells carry the bounds of the donors they hold.
    """
    fine = max(bits - MAX_BITS, 0)
    every = 2 ** max(MAX_BITS - bits, 0)
    if not bits:
        return donors.withColumn(name, F.lit(0).cast("bigint"))
    cuts = sorted(set(marks[every - 1 :: every]))
    donors = with_range_number(donors, point, name, cuts)
    if not fine or len(cuts) < 2:
        return donors.withColumn(name, F.shiftleft(F.col(name).cast("bigint"), fine))
    edges = F.lit(cuts)
    low, high = F.get(edges, F.col(name) - 1), F.get(edges, F.col(name))
    part = F.floor(F.try_divide(F.col(point) - low, high - low) * 2**fine)
    part = F.greatest(F.least(F.coalesce(part, F.lit(0)), F.lit(2**fine - 1)), F.lit(0)).cast("bigint")
    return donors.withColumn(name, F.shiftleft(F.col(name).cast("bigint"), fine) + part)


def _cells(donors: DataFrame, d: int) -> DataFrame:
    """Count and bounds of every non-empty cell of each search's finest level."""
    bounds = [f(f"_f{i}").alias(f"_{n}{i}") for i in range(d) for f, n in ((F.min, "lo"), (F.max, "hi"))]
    return donors.groupBy("_s", "_bits", *_bins(d)).agg(F.count(F.lit(1)).alias("_n"), *bounds)


def _cut_at(marks: Sequence[Sequence[float]]) -> tuple[list[int], list[int]]:
    """For each coordinate: the level from which it is cut, and the most bits that tell its values apart.

    The widest coordinate is cut from the first level on, one of half its width from the second. Width is that of the
    middle nine tenths, or all of it where they are one value.
    """
    width = []
    for m in marks:
        middle = m[len(m) * 19 // 20] - m[len(m) // 20] if m else 0.0
        width.append(middle or (m[-1] - m[0] if m else 0.0))
    widest = max(width)
    lags = [min(round(math.log2(widest / w)), MAX_LAG) if w > 0 and math.isfinite(widest / w) else MAX_LAG for w in width]
    distinct = [len(set(m)) for m in marks]
    most = [MAX_CUT if n >= 2 ** (MAX_BITS - 1) else n.bit_length() for n in distinct]
    return [lag if math.isfinite(widest) else 0 for lag in lags], most


def _cut_bits(level: Column, lag: int, most: int) -> Column:
    """Bits of a coordinate's cell number at a level."""
    return F.least(F.greatest(level - lag, F.lit(0)), F.lit(most))


def _cut_sum(level: int, cut: tuple[list[int], list[int]]) -> int:
    return sum(min(max(level - lag, 0), most) for lag, most in zip(*cut))


def _dropped(number: str, bits: Column) -> Column:
    return F.floor(F.col(number) / F.pow(F.lit(2.0), bits)).cast("bigint")


def _coarser(cells: DataFrame, cut: tuple[list[int], list[int]], level: int, split: int | None = None) -> DataFrame:
    """The cells merged to a level; coordinates beyond ``split`` are not told apart."""
    d = len(cut[0])
    split = d if split is None else split
    keys = []
    for i, (b, lag, most) in enumerate(zip(_bins(d), *cut)):
        last = _cut_bits(F.col("_bits"), lag, most) - _cut_bits(F.least("_bits", F.lit(level)), lag, most)
        keys.append((_dropped(b, last) if i < split else F.lit(0).cast("bigint")).alias(b))
    bounds = [f(f"_{n}{i}").alias(f"_{n}{i}") for i in range(d) for f, n in ((F.min, "lo"), (F.max, "hi"))]
    return cells.groupBy("_s", "_bits", *keys).agg(F.sum("_n").alias("_n"), *bounds)


def _nearest_square(d: int) -> Column:
    """Squared distance to the closest point of the cell bounds."""
    gap = [F.greatest(F.col(f"_lo{i}") - F.col(f"_f{i}"), F.col(f"_f{i}") - F.col(f"_hi{i}"), F.lit(0.0)) for i in range(d)]
    return reduce(add, [g * g for g in gap])


def _farthest_square(d: int) -> Column:
    """Squared distance to the farthest point of the cell bounds."""
    gap = [F.greatest(F.col(f"_hi{i}") - F.col(f"_f{i}"), F.col(f"_f{i}") - F.col(f"_lo{i}")) for i in range(d)]
    return reduce(add, [g * g for g in gap])


def _pruned(frontier: DataFrame, d: int, k: int) -> DataFrame:
    """Keeps the cells that may hold one of the k nearest donors of their query.

    A cell with at least k donors bounds the k-th distance by its farthest point. The bound found at coarser levels is
    carried along, with a hair of slack for rounding, and is used before rows are shuffled.
    """
    frontier = frontier.filter(_nearest_square(d) <= F.col("_limit") * (1 + 1e-9))
    sure = F.when(F.col("_n") >= k, _farthest_square(d))
    bound = F.min(F.least("_limit", sure)).over(Window.partitionBy("_s", "_q"))
    return (
        frontier.withColumn("_limit", bound)
        .filter(_nearest_square(d) <= F.col("_limit") * (1 + 1e-9))
        .select("_s", "_q", "_limit", *[f"_f{i}" for i in range(d)], *_bins(d))
    )


def nearest_donors(
    queries: DataFrame, donors: DataFrame, d: int, k: int, donors_per_cell: int = DONORS_PER_CELL
) -> DataFrame:
    """(_q, _d, _key, _value): the k nearest donors of each query by squared distance, then by donor key.

    ``queries`` holds ``_q`` (unique) and ``donors`` holds ``_key`` and ``_value``; both hold coordinates ``_f0`` to
    ``_f<d-1>`` without missing values.
    """
    one = {"_s": F.lit(0), "_m": F.lit((1 << d) - 1)}
    return masked_donors(queries.withColumns(one), donors.withColumns(one), d, k, donors_per_cell).drop("_s", "_m")


def masked_donors(
    queries: DataFrame, donors: DataFrame, d: int, k: int, donors_per_cell: int = DONORS_PER_CELL
) -> DataFrame:
    """(_s, _m, _q, _d, _key, _value): the k nearest donors of each query within its search ``_s``, for all searches at once.

    Both tables hold the search and its mask ``_m``, whose bits tell the coordinates that count in it; the others are 0 in
    its rows. The search is part of the key of the cells. Each has cells as fine as its donors and coordinates ask for, and
    all descend the levels together, so the number of jobs does not follow the number of searches.
    """
    points = [f"_f{i}" for i in range(d)]
    # of donors at one point only the first k by key can count, and the ranking drops the others before the shuffle
    same = Window.partitionBy("_s", *points).orderBy("_key")
    donors = written(donors.withColumn("_rank", F.row_number().over(same)).filter(F.col("_rank") <= k).drop("_rank"))

    # one sketch per coordinate over the donors it counts for, and the level of every search's finest cells from its size
    marks = [i / 2**MAX_BITS for i in range(1, 2**MAX_BITS)]
    seen = [F.when(F.col("_m").bitwiseAND(1 << i) > 0, F.col(p)) for i, p in enumerate(points)]
    fit = donors.agg(*[F.percentile_approx(x, marks, 10_000).alias(p) for x, p in zip(seen, points)]).first()
    cut = _cut_at([fit[p] or [] for p in points])

    def cuts(level: Column) -> Column:
        return reduce(add, [
            F.when(F.col("_m").bitwiseAND(1 << i) > 0, _cut_bits(level, lag, most)).otherwise(0) for i, (lag, most) in enumerate(zip(*cut))])

    wide = F.log2(F.greatest(F.col("_n") / donors_per_cell, F.lit(2.0)))
    levels = F.sequence(F.lit(1), F.lit(MAX_LAG + MAX_CUT))
    deep = F.coalesce(F.array_min(F.filter(levels, lambda level: cuts(level) >= wide)), F.lit(MAX_LAG + MAX_BITS))
    sizes = donors.groupBy("_s", "_m").agg(F.count(F.lit(1)).alias("_n")).withColumn("_bits", deep.cast("int"))
    sizes = written(sizes.select("_s", "_bits"))
    bits = sizes.agg(F.max("_bits")).first()[0]  # a row per search
    if bits is None:
        return _no_neighbours(queries, donors)
    for b, p, lag, most in zip(_bins(d), points, *cut):
        donors = _numbered(donors, p, b, fit[p] or [], min(max(bits - lag, 0), most))
    donors = donors.join(F.broadcast(sizes), "_s")
    donors = donors.withColumns({
        b: _dropped(b, F.lit(min(max(bits - lag, 0), most)) - _cut_bits(F.col("_bits"), lag, most)) for b, lag, most in zip(_bins(d), *cut)})

    finest = written(_cells(donors, d))
    start = int(math.log2(START_CELLS))
    level = max([n for n in range(1, bits + 1) if _cut_sum(n, cut) <= start], default=1)
    split = min(d, start)  # coordinates told apart at the start; the others from the first step on
    top = _coarser(finest, cut, level, split).drop("_bits")  # at most START_CELLS rows per search
    asked = queries.select("_s", "_q", *points, F.lit(float("inf")).alias("_limit"))
    frontier = _pruned(asked.join(F.broadcast(top), "_s"), d, k)
    while level < bits or split < d:
        last = level
        level = max([n for n in range(last + 1, bits + 1) if _cut_sum(n, cut) - _cut_sum(last, cut) <= CHILD_BITS],
                    default=min(last + 1, bits))
        parent = {}
        for i, (b, lag, most) in enumerate(zip(_bins(d), *cut)):
            fewer = _cut_bits(F.least("_bits", F.lit(level)), lag, most) - _cut_bits(F.least("_bits", F.lit(last)), lag, most)
            parent[f"_p{i}"] = _dropped(b, fewer) if i < split else F.lit(0).cast("bigint")
        children = _coarser(finest, cut, level).withColumns(parent).drop("_bits")
        split = d
        parents = frontier.withColumnsRenamed({b: f"_p{i}" for i, b in enumerate(_bins(d))})
        frontier = _pruned(parents.join(children, ["_s", *[f"_p{i}" for i in range(d)]]), d, k)

    near = frontier.select("_s", "_q", "_limit", *[F.col(p).alias(f"_at{i}") for i, p in enumerate(points)], *_bins(d))
    square = reduce(add, [(F.col(f"_at{i}") - F.col(p)) * (F.col(f"_at{i}") - F.col(p)) for i, p in enumerate(points)])
    met = near.join(donors, ["_s", *_bins(d)]).filter(square <= F.col("_limit") * (1 + 1e-9))
    return _first(met.select("_s", "_m", "_q", square.alias("_d"), "_key", "_value"), k, "_s", "_q")


def _first(candidates: DataFrame, k: int, *by: str) -> DataFrame:
    window = Window.partitionBy(*by).orderBy("_d", "_key")
    return candidates.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") <= k).drop("_rank")


def _no_neighbours(queries: DataFrame, donors: DataFrame) -> DataFrame:
    """An empty result."""
    nobody = F.lit(None).cast(queries.schema["_q"].dataType).alias("_q")
    return donors.filter(F.lit(False)).select("_s", "_m", nobody, F.lit(0.0).alias("_d"), "_key", "_value")


def _neighbours(
    df: DataFrame, column: str, features: Sequence[str], key: str, k: int, coordinates: int, donors_per_cell: int
) -> DataFrame:
    """Nearest donors of every distinct feature vector among the rows missing ``column``.

    Distances use the coordinates both rows have, scaled up by the share they are of all ``coordinates``. Which features a
    row has is a mask. A search is a donors' mask with the part of it that a query shares; a donor takes part in the
    searches of all queries' masks, a query in those of all donors' masks, and all of them are one ``masked_donors``.
    """
    d = len(features)
    have = reduce(add, [F.when(F.col(f).isNull(), 0).otherwise(1 << i) for i, f in enumerate(features)])
    base = df.select(
        F.col(key).alias("_key"), F.col(column).alias("_value"), F.struct(*features).alias("_q"),
        *[F.col(f).cast("double").alias(f"_x{i}") for i, f in enumerate(features)], have.alias("_have"),
    )
    masks = base.agg(  # at most one entry per mask
        F.collect_set(F.when(F.col("_value").isNull(), F.col("_have"))).alias("asked"),
        F.collect_set(F.when(F.col("_value").isNotNull(), F.col("_have"))).alias("offered")).first()

    def searched(rows: DataFrame, others: Sequence[int], offers: bool) -> DataFrame:
        """Rows with their searches; coordinates outside a search's mask are 0."""
        def search(other: Column) -> Column:
            shared = F.col("_have").bitwiseAND(other)
            whose = F.col("_have") if offers else other
            return F.struct((whose * (1 << d) + shared).alias("_s"), shared.alias("_m"))

        listed = F.array_distinct(F.transform(F.array(*[F.lit(m) for m in sorted(others)]).cast("array<int>"), search))
        rows = rows.withColumn("_r", F.explode(listed)).select("*", "_r.*").filter("_m <> 0")
        return rows.withColumns(
            {f"_f{i}": F.when(F.col("_m").bitwiseAND(1 << i) > 0, F.col(f"_x{i}")).otherwise(0.0) for i in range(d)})

    points = [f"_f{i}" for i in range(d)]
    queries = searched(base.filter("_value IS NULL").dropDuplicates(["_q"]), masks.offered, False)
    donors = searched(base.filter("_value IS NOT NULL"), masks.asked, True)
    near = masked_donors(
        queries.select("_s", "_m", "_q", *points), donors.select("_s", "_m", "_key", "_value", *points), d, k, donors_per_cell)
    near = near.withColumn("_d", F.col("_d") * F.lit(coordinates) / F.bit_count("_m")).drop("_s", "_m")
    return near if len(masks.offered) < 2 else _first(near, k, "_q")


def _answers(missing: DataFrame, features: Sequence[str], values: DataFrame, default: Column) -> DataFrame:
    """The rows of ``missing`` with ``_new``, from ``values(_q, _new)`` or the default."""
    joined = lookup_join(missing.withColumn("_q", F.struct(*features)), written(values), ["_q"])
    return joined.withColumn("_new", F.coalesce("_new", default)).drop("_q")


def _filled(df: DataFrame, column: str, answers: DataFrame) -> DataFrame:
    """``df`` with its rows that miss ``column`` taken from ``answers``."""
    kind = answers.schema["_new"].dataType
    complete = df.filter(F.col(column).isNotNull()).withColumn(column, F.col(column).cast(kind))
    return complete.unionByName(answers.withColumn(column, F.col("_new")).select(*df.columns))


def _number_answers(
    df: DataFrame, column: str, features: Sequence[str], key: str, k: int, donors_per_cell: int
) -> DataFrame:
    near = _neighbours(df, column, features, key, k, len(features) + 1, donors_per_cell)
    values = near.groupBy("_q").agg(F.avg(F.col("_value").cast("double")).alias("_new"))
    mean = F.lit(fit_stats(df, [column])[column].mean).cast("double")
    return _answers(df.filter(F.col(column).isNull()), features, values, mean)


def _category_answers(
    df: DataFrame, column: str, features: Sequence[str], key: str, k: int, donors_per_cell: int
) -> DataFrame:
    near = _neighbours(df, column, features, key, k, len(features), donors_per_cell)
    values = near.groupBy("_q").agg(F.mode("_value", True).alias("_new"))
    return _answers(df.filter(F.col(column).isNull()), features, values, F.lit(None).cast("string"))


def impute_numeric(
    df: DataFrame,
    column: str,
    features: Sequence[str],
    key: str = "customer_id",
    k: int = NUMERIC_NEIGHBOURS,
    donors_per_cell: int = DONORS_PER_CELL,
) -> DataFrame:
    """Missing numbers as the mean of the k nearest rows on ``features``; the column mean where no row is comparable."""
    return _filled(df, column, _number_answers(df, column, features, key, k, donors_per_cell))


def impute_category(
    df: DataFrame,
    column: str,
    features: Sequence[str],
    key: str = "customer_id",
    k: int = CATEGORY_NEIGHBOURS,
    donors_per_cell: int = DONORS_PER_CELL,
) -> DataFrame:
    """Missing categories by majority among the k nearest rows, the smallest category on a tie."""
    return _filled(df, column, _category_answers(df, column, features, key, k, donors_per_cell))


def importance_spread(df: DataFrame, column: str, features: Sequence[str], seed: int = 123, depth: int = DEPTH) -> list[tuple[str, float]]:
    """Features by the standard deviation of their importance over a few entropy trees, highest first, else in order."""
    labels = fit_labels(df, column)
    place = F.array_position(F.array(*[F.lit(v) for v in labels]), F.col(column).cast("string"))
    found = tree_importances(df, F.when(place > 0, place - 1), len(labels), features, seed=seed, depth=depth)
    spread = [round(float(s), 9) for s in found.std(axis=0)]
    return sorted(zip(features, spread), key=lambda item: -item[1])


def impute_missing(
    df: DataFrame,
    key: str = "customer_id",
    columns: Sequence[str] | None = None,
    donors_per_cell: int = DONORS_PER_CELL,
) -> DataFrame:
    """Fills every column with missing values, numbers first, each from the table as completed so far.

    A number is filled from its most correlated columns, by sign, a category from the numeric columns, filled ones
    included, whose importance varies most. Rows are numbered and written once; what later columns rest on is kept as a
    table of the numbers alone, and all answers, one row per hole, are joined to the rows at the end.
    """
    shared_folder(df.sparkSession)
    columns = [c for c in df.columns if c != key] if columns is None else list(columns)
    df = written(df.withColumn("_row", F.monotonically_increasing_id()))
    known = df.agg(F.count("*").alias("_rows"), *[F.count(c).alias(c) for c in columns]).first().asDict()
    holes = {c: known["_rows"] - known[c] for c in columns}
    numeric = [c for c in numeric_columns(df) if c in columns]
    pairs = {}
    if any(holes[c] for c in numeric):
        for r in correlations(df, numeric).collect():
            pairs[r.first, r.second] = pairs[r.second, r.first] = r["corr"]
    numbers, answers = df.select("_row", key, *numeric), []
    for column in [c for c in numeric if holes[c]]:
        others = [c for c in numeric if pairs.get((column, c)) is not None]
        features = sorted(others, key=lambda c: -pairs[column, c])[: CORRELATED_COLUMNS - 1]
        if features:
            found = written(_number_answers(numbers, column, features, key, NUMERIC_NEIGHBOURS, donors_per_cell))
            answers.append(found.select("_row", F.lit(column).alias("_column"), F.col("_new").alias("_number"), F.lit(None).cast("string").alias("_text")))
            numbers = written(_filled(numbers, column, found))
        else:  # no row is comparable
            mean = fit_stats(df, [column])[column].mean
            numbers = numbers.withColumn(column, F.coalesce(F.col(column).cast("double"), F.lit(mean)))
            df = df.withColumn(column, F.coalesce(F.col(column).cast("double"), F.lit(mean)))
    complete = [c for c in numeric if known[c]]  # by now without holes
    texts = [c for c in columns if c not in numeric and holes[c]]
    if texts and not complete:
        raise ValueError(f"no numeric column with a value to fill {', '.join(texts)} from")
    if texts:
        told = numbers.join(df.select("_row", *texts), "_row")
        told = written(told) if len(texts) > 1 else told
    for column in texts:
        features = [f for f, _ in importance_spread(told, column, complete)[:CATEGORY_FEATURES]]
        found = _category_answers(told, column, features, key, CATEGORY_NEIGHBOURS, donors_per_cell)
        answers.append(found.select("_row", F.lit(column).alias("_column"), F.lit(None).cast("double").alias("_number"), F.col("_new").cast("string").alias("_text")))
    if not answers:
        return df.drop("_row")
    by_row = reduce(DataFrame.unionByName, answers).groupBy("_row")

    def answer(column: str) -> Column:
        return F.max(F.when(F.col("_column") == column, F.col("_number" if column in numeric else "_text"))).alias(f"_new_{column}")

    filled = [c for c in columns if holes[c] and (c in texts or any(pairs.get((c, o)) is not None for o in numeric))]
    whole = df.join(by_row.agg(*[answer(c) for c in filled]), "_row", "left")
    kinds = {c: "double" if c in numeric else "string" for c in filled}
    return whole.select(*[
        F.coalesce(F.col(c).cast(kinds[c]), F.col(f"_new_{c}")).alias(c) if c in filled else F.col(c) for c in df.columns if c != "_row"
    ])
