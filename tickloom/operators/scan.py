"""Ordered scans that never put a whole ordered stream into one task.

A running maximum, a running sum or a previous row over a long (or
un-partitioned) order would make Spark sort everything in one task. Here the
order is cut into blocks: a map-side aggregate summarises each block, a window
over the small block table gives every block the state it starts from, and one
shuffle by (keys, block) finishes the scan inside the blocks. The starting
state travels as one extra row per block, so there is no join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.session import work_dir

BLOCK_ROWS = 1 << 20

_BLOCK, _REAL = "__block", "__real"
_FOLDS = {"max": F.max, "sum": F.sum}


def arrival_block(df: DataFrame, arrival: str = "arrival", rows: int = BLOCK_ROWS) -> Column:
    """The block of an arrival value; blocks follow the arrival order.

    Integers (sequence numbers) are cut every ``rows`` values, and so is a struct
    led by a BIGINT (a topic's offset and partition); any other struct is cut by all
    fields but its last one, i.e. by file split.
    """
    kind = df.schema[arrival].dataType
    if isinstance(kind, T.StructType):
        if isinstance(kind[0].dataType, T.LongType):
            return F.expr(f"`{arrival}`.`{kind[0].name}` div {rows}")
        return F.struct(*[F.col(arrival)[name].alias(name) for name in kind.fieldNames()[:-1]])
    return F.expr(f"`{arrival}` div {rows}")


def value_block(value: Column) -> Column:
    """Block of a number when rows are ordered by it: 256 steps per power of two."""
    size = F.abs(value.cast("double"))
    exponent = F.floor(F.log2(size))
    step = (exponent + 1100) * 256 + F.floor(size / F.pow(F.lit(2.0), exponent) * 256)
    return F.when(size == 0, F.lit(0)).otherwise(F.signum(value) * step).cast("bigint")


def time_block(instant: Column, seconds: int = 3600) -> Column:
    """Block of a row ordered by a time in seconds."""
    return F.floor(instant / F.lit(seconds)).cast("bigint")


def running(
    df: DataFrame,
    *,
    order: str,
    block: Column,
    values: dict[str, tuple[str, str]],
    keys: list[str] = [],
    inclusive: bool = False,
) -> DataFrame:
    """Add running folds: ``values`` maps a new column to (column, 'max' or 'sum'), each column used once.

    Exclusive unless ``inclusive``: a row sees the rows before it in its keys.
    Keys must not be NULL.
    """
    rows = df.withColumns({_BLOCK: block, _REAL: F.lit(True)})
    folds = [(new, column, _FOLDS[how]) for new, (column, how) in values.items()]
    blocks = rows.groupBy(*keys, _BLOCK).agg(*[fold(c).alias(c) for _, c, fold in folds])
    earlier = Window.partitionBy(*keys).orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    seeds = blocks.select(*keys, _BLOCK, *[fold(c).over(earlier).alias(c) for _, c, fold in folds], F.lit(False).alias(_REAL))
    last = 0 if inclusive else -1
    upto = Window.partitionBy(*keys, _BLOCK).orderBy(_REAL, order).rowsBetween(Window.unboundedPreceding, last)
    return (
        rows.unionByName(seeds, allowMissingColumns=True)
        .select("*", *[fold(c).over(upto).alias(new) for new, c, fold in folds])
        .where(F.col(_REAL))
        .drop(_BLOCK, _REAL)
    )


def neighbours(
    df: DataFrame,
    *,
    order: str,
    block: Column,
    before: dict[str, str] = {},
    after: dict[str, str] = {},
    keys: list[str] = [],
) -> DataFrame:
    """Add columns of the previous row (``before``) and the next row (``after``) of the same keys.

    Both map a new name to an existing column. Keys must not be NULL.
    """
    rows = df.withColumns({_BLOCK: block, _REAL: F.lit(0)})
    by_block = Window.partitionBy(*keys).orderBy(_BLOCK)
    carried = sorted({*before.values(), *after.values()})

    def edge(pick) -> Column:
        return F.struct(*[pick(F.col(c), F.col(order)).alias(c) for c in carried])

    blocks = rows.groupBy(*keys, _BLOCK).agg(edge(F.max_by).alias("last"), edge(F.min_by).alias("first"))
    around = blocks.select(
        *keys, _BLOCK, F.lag("last").over(by_block).alias("last"), F.lead("first").over(by_block).alias("first")
    )
    # One row opens a block with the previous block's last row, one closes it with the next block's first.
    places = [F.struct(F.lit(-1).alias(_REAL), F.col("last").alias("e"))] if before else []
    places += [F.struct(F.lit(1).alias(_REAL), F.col("first").alias("e"))] if after else []
    seeds = around.select(*keys, _BLOCK, F.inline(F.array(*places))).select(*keys, _BLOCK, _REAL, "e.*")
    inside = Window.partitionBy(*keys, _BLOCK).orderBy(_REAL, order)
    shifted = [F.lag(c).over(inside).alias(new) for new, c in before.items()]
    shifted += [F.lead(c).over(inside).alias(new) for new, c in after.items()]
    return (
        rows.unionByName(seeds, allowMissingColumns=True)
        .select("*", *shifted)
        .where(F.col(_REAL) == 0)
        .drop(_BLOCK, _REAL)
    )


def affine_starts(steps: DataFrame, keys: list[str], levels: list[str], seed: float) -> DataFrame:
    """Where every step of a chain of maps ``x -> weight * x + own`` starts: keys, levels and ``start``.

    ``levels`` place a step in the chain of its keys, coarse to fine, and are unique there. The steps of a place are composed
    to one map, level by level up to the coarsest, whose maps are chained by a window; then the starts are handed down inside
    the rows, without a join. So a row holds the steps of one place of the coarsest level, however long the chain is. Keys
    and levels must not be NULL.
    """
    identity = F.struct(F.lit(1.0).alias("weight"), F.lit(0.0).alias("own"))

    def composed(f: Column, s: Column) -> Column:
        return F.struct((f["weight"] * s["weight"]).alias("weight"), (s["weight"] * f["own"] + s["own"]).alias("own"))

    maps, inner = steps.select(*keys, *levels, "weight", "own"), []
    for depth in range(len(levels) - 1, 0, -1):
        place = [*keys, *levels[:depth]]
        listed = F.sort_array(F.collect_list(F.struct(levels[depth], "weight", "own", *inner))).alias("inside")
        whole = F.aggregate("inside", identity, composed).alias("whole")
        maps = maps.groupBy(*place).agg(listed).select(*place, "inside", whole).select(*place, "whole.*", "inside")
        inner = ["inside"]
    earlier = Window.partitionBy(*keys).orderBy(levels[0]).rowsBetween(Window.unboundedPreceding, -1)
    before = F.collect_list(F.struct("weight", "own")).over(earlier)
    begun = F.aggregate(before, F.lit(float(seed)), lambda x, s: s["weight"] * x + s["own"])
    starts = maps.select(*keys, levels[0], *inner, begun.alias("start"))
    for depth in range(1, len(levels)):
        inner = inner if depth < len(levels) - 1 else []
        starts = starts.select(*keys, *levels[:depth], F.inline_outer(_chained(starts, [levels[depth], *inner])))
    return starts


def _chained(starts: DataFrame, carried: list[str]) -> Column:
    """The steps ``inside`` a row with the ``start`` of each, the first one's being the row's."""
    step = starts.schema["inside"].dataType.elementType
    fields = [f"{c}:{step[c].dataType.simpleString()}" for c in carried]
    none = F.array().cast(f"array<struct<{','.join(fields)},start:double>>")

    def chain(state: Column, s: Column) -> Column:
        entry = F.struct(*[s[c].alias(c) for c in carried], state["x"].alias("start"))
        return F.struct((s["weight"] * state["x"] + s["own"]).alias("x"), F.array_append(state["out"], entry).alias("out"))

    return F.aggregate("inside", F.struct(F.col("start").alias("x"), none.alias("out")), chain, lambda state: state["out"])


def _in_ranges(df: DataFrame, *order: Column) -> DataFrame:
    """The rows stored in ranges of about equal size, with ``__id``: their place, the range in its upper bits.

    Spark cuts the ranges by a sample of the whole order, ties included, so a value that very many rows share is cut
    as well. They are stored, so that every later use sees the same ranges.
    """
    spark = df.sparkSession
    path = work_dir(spark, "ranges")
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered.withColumn("__id", F.monotonically_increasing_id()).write.parquet(path)
    return spark.read.schema(T.StructType([*df.schema.fields, T.StructField("__id", T.LongType())])).parquet(path)


def ranked(df: DataFrame, value: str, tie: str, cumulative: dict[str, str], rank: str = "rank") -> DataFrame:
    """Row number by ``value`` descending then ``tie``, with running totals (new name → column).

    The rows are stored in ranges of this order; sums per range give every range what lies before it.
    """
    placed = _in_ranges(df, F.col(value).desc(), F.col(tie).asc()).withColumn("__one", F.lit(1))
    return running(
        placed,
        order="__id",
        block=F.shiftright("__id", 33),
        values={rank: ("__one", "sum"), **{new: (c, "sum") for new, c in cumulative.items()}},
        inclusive=True,
    ).drop("__id", "__one")


def numbered(df: DataFrame, column: str, number: str = "number") -> DataFrame:
    """Rows numbered from 0 in order of a column whose values differ."""
    placed = _in_ranges(df, F.col(column).asc()).withColumn("__one", F.lit(1))
    counted = running(placed, order="__id", block=F.shiftright("__id", 33), values={number: ("__one", "sum")}, inclusive=True)
    return counted.withColumn(number, F.col(number) - 1).drop("__id", "__one")


def quantiles(
    df: DataFrame, value: str, fractions: dict[str, float], keys: list[str] = [], nearest: bool = False, weight: str | None = None
) -> DataFrame:
    """Exact quantiles per key in one row: output name → fraction.

    Linear interpolation between the two nearest ranks, or with ``nearest`` the
    value at rank ``round((n-1)·f)``, halves to even. Equal values are counted
    before the shuffle and ranks come from a blocked scan, so no task holds all
    values of a key. ``weight`` names a column that says how often a row counts.
    """
    often = F.count("*") if weight is None else F.sum(weight)
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(often.alias("__n"))
    placed = running(
        counts, keys=keys, order=value, block=value_block(F.col(value)), values={"__before": ("__n", "sum")}
    ).withColumn("__before", F.coalesce("__before", F.lit(0)))
    sizes = counts.groupBy(*keys).agg(F.sum("__n").alias("__size"))
    placed = placed.join(sizes, keys) if keys else placed.withColumn("__size", sizes.scalar())

    def at(rank: Column) -> Column:
        inside = (F.col("__before") <= rank) & (rank < F.col("__before") + F.col("__n"))
        return F.max(F.when(inside, F.col(value)))

    aggregates, results = [], []
    for name, fraction in fractions.items():
        place = (F.col("__size") - 1) * F.lit(fraction)
        if nearest:
            aggregates.append(at(F.bround(place).cast("bigint")).alias(name))
            results.append(F.col(name))
        else:
            aggregates += [
                at(F.floor(place)).alias(f"__lo_{name}"),
                at(F.ceil(place)).alias(f"__hi_{name}"),
                F.max(place - F.floor(place)).alias(f"__part_{name}"),
            ]
            low, high = F.col(f"__lo_{name}"), F.col(f"__hi_{name}")
            results.append((low + (high - low) * F.col(f"__part_{name}")).alias(name))
    return placed.groupBy(*keys).agg(*aggregates).select(*keys, *results)


def runs(df: DataFrame, *, flag: Column, order: Column, block: Column, keys: list[str]) -> DataFrame:
    """Rows numbered by runs of flagged rows: keys, ``o`` (the order), ``f``, ``run`` and ``hits``.

    ``run`` counts the breaks before a row, so a run's group also holds the row
    that ends it; ``hits`` counts the flagged rows before a row. Rows whose flag
    is NULL neither extend nor break a run and are left out.
    """
    rows = df.select(*keys, order.alias("o"), block.alias("b"), flag.cast("int").alias("f")).where("f IS NOT NULL")
    return running(
        rows.withColumn("broken", 1 - F.col("f")),
        keys=keys,
        order="o",
        block=F.col("b"),
        values={"run": ("broken", "sum"), "hits": ("f", "sum")},
    ).select(*keys, "o", "f", F.coalesce("run", F.lit(0)).alias("run"), F.coalesce("hits", F.lit(0)).alias("hits"))


def first_run(numbered: DataFrame, n: int, keys: list[str], accept_open: bool = False) -> DataFrame:
    """Per key, the first run of at least ``n`` rows: keys, ``run``, ``run_start`` and ``first_hit``.

    With ``accept_open`` a shorter run that the end of the data leaves open also counts.
    """
    sizes = numbered.groupBy(*keys, "run").agg(
        F.sum("f").alias("size"),
        F.min(F.when(F.col("f") == 1, F.col("o"))).alias("run_start"),
        F.min("hits").alias("first_hit"),
        F.count_if(F.col("f") == 0).alias("ended"),
    )
    good = F.col("size") >= n
    if accept_open:
        good = good | ((F.col("ended") == 0) & (F.col("size") > 0))
    earliest = F.min_by(F.struct("run", "run_start", "first_hit"), "run").alias("r")
    return sizes.where(good).groupBy(*keys).agg(earliest).select(*keys, "r.*")


def nth_of_first_run(numbered: DataFrame, n: int, keys: list[str]) -> DataFrame:
    """Per key, ``confirmed_at``: the order of the n-th row of the first run of at least ``n`` rows."""
    first = first_run(numbered, n, keys)
    flagged = numbered.where("f = 1").join(first, [*keys, "run"])
    nth = flagged.where(F.col("hits") == F.col("first_hit") + n - 1)
    return nth.select(*keys, F.col("o").alias("confirmed_at"))
