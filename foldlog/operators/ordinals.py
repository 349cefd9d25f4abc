"""Row numbers over a whole frame and within keys, without one task holding all rows.

**Numbers over a frame.** Rows are range-partitioned, sorted, numbered within their range and
staged; counts per range become offsets. Spark samples the keys of a range exchange to the driver,
and sort keys may be whole documents, so rows are ranged on a short key that sorts like the whole
one: values of text are cut, and nothing after a value that was cut takes part. Rows that tie on it
share a range. Short keys that hold too many rows are found beforehand, with a sketch of frequent
items, and only their rows are told apart by longer keys: by more of the text first, and by the
whole key where that is too frequent as well.

**Counts within keys.** Rows are hashed by key, so the count is a window after one exchange. Keys
that hold too many rows are dealt into blocks that follow the order, by bounds sampled from their
rows; a block's count is carried on to the later blocks of its key.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldlog.staging import stage

_MARK, _RANGE, _SLOT, _SKIP = "__mark", "__range", "__slot", "__skip"
_HASH, _BOUNDS, _BLOCK, _COUNT = "__hash", "__bounds", "__block", "__count"

#: Characters of text that stand for a value in short keys, level by level.
LENGTHS = (16, 256)
#: A group of equal short keys, or a key, is too large if it would fill this part of a partition.
_PART = 4
#: Rows that any task can hold: smaller groups are not looked at.
_FEW = 1_000
#: Rows sampled for each bound between blocks.
_SAMPLED = 32

RowWise = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Key:
    """A column to sort by, its direction and the place of NULL."""

    name: str
    descending: bool = False
    nulls_last: bool = False

    def sorted(self, value: Column) -> Column:
        """``value`` as a sort expression of this direction."""
        if self.descending:
            return value.desc_nulls_last() if self.nulls_last else value.desc_nulls_first()
        return value.asc_nulls_last() if self.nulls_last else value.asc_nulls_first()

    def column(self) -> Column:
        return F.col(f"`{self.name}`")

    def precedes(self, left: Column, right: Column) -> Column:
        """Whether ``left`` sorts before ``right``; never NULL."""
        one_null = (left.isNotNull() & right.isNull()) if self.nulls_last else (left.isNull() & right.isNotNull())
        return F.coalesce(left > right if self.descending else left < right, one_null)


def ascending(name: str) -> Key:
    """Smallest first, NULL before all."""
    return Key(name)


def descending(name: str) -> Key:
    """Largest first, NULL after all."""
    return Key(name, descending=True, nulls_last=True)


def _total(order: Sequence[Key], unique: Sequence[str]) -> list[Key]:
    if not unique:
        raise ValueError("name the columns that make the order total")
    return [*order, *(ascending(name) for name in unique)]


def short_key(df: DataFrame, keys: Sequence[Key], length: int) -> list[tuple[Key, Column]]:
    """Values that sort like ``keys``, with ties: text is cut to ``length`` characters.

    After the cut text comes whether it was cut: what is left of a text is less than any text that
    goes on. Columns after a value that was cut are NULL. Nested columns count as cut.
    """
    parts: list[tuple[Key, Column]] = []
    cut = F.lit(False)
    for key in keys:
        kind, value = df.schema[key.name].dataType, key.column()
        if isinstance(kind, (T.StringType, T.BinaryType)):
            longer = F.coalesce(F.length(value) > length, F.lit(False))
            parts += [(key, F.when(~cut, F.substring(value, 1, length))), (key, F.when(~cut, longer))]
            cut = cut | longer
        elif isinstance(kind, (T.ArrayType, T.StructType, T.MapType, T.VariantType)):
            break
        else:
            parts.append((key, F.when(~cut, value)))
    return parts or [(keys[0], F.lit(0))]


def _partitions(spark: SparkSession) -> int:
    return int(
        spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
        or spark.conf.get("spark.sql.shuffle.partitions")
    )


def _frequent(df: DataFrame, *hashes: Column) -> tuple[int, list[dict[int, int]]]:
    """The number of rows, and of each column of hashes those that too many rows have, with counts.

    One pass with a sketch of bounded size. A group that the sketch underrates is only less evenly
    spread; results do not depend on it.
    """
    partitions = _partitions(df.sparkSession)
    most, tracked = min(_PART * partitions, 100_000), min(max(64 * partitions, 10_000), 1_000_000)
    found = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *(
            F.call_function("approx_top_k", value, F.lit(most), F.lit(tracked)).alias(f"h{k}")
            for k, value in enumerate(hashes)
        ),
    ).first()
    least = max(_FEW, found["rows"] // (_PART * partitions))
    return found["rows"], [
        {item["item"]: item["count"] for item in found[f"h{k}"] or [] if item["item"] is not None and item["count"] > least}
        for k in range(len(hashes))
    ]


def ranged(df: DataFrame, keys: Sequence[Key]) -> DataFrame:
    """The rows in range partitions that follow ``keys``; equal short keys may share one."""
    shorts = [short_key(df, keys, length) for length in LENGTHS]
    hashes = [F.xxhash64(*(value for _, value in short)) for short in shorts]
    _, frequent = _frequent(df, *hashes)
    levels = [*shorts[1:], [(key, key.column()) for key in keys]]
    by, rows, flagged, added = list(shorts[0]), df, F.lit(True), []
    for k, (own, level) in enumerate(zip(frequent, levels)):
        if not own:
            break
        # Few by their share of all rows.
        flag = f"__frequent{k}"
        listed = df.sparkSession.createDataFrame([(h,) for h in own], f"__hash{k} bigint").withColumn(flag, F.lit(True))
        rows = rows.withColumn(f"__hash{k}", hashes[k]).join(F.broadcast(listed), f"__hash{k}", "left")
        flagged = flagged & F.coalesce(F.col(flag), F.lit(False))
        by += [(key, F.when(flagged, value)) for key, value in level]
        added += [flag, f"__hash{k}"]
    return rows.repartitionByRange(*(key.sorted(value) for key, value in by)).drop(*added)


def _in_ranges(df: DataFrame, keys: Sequence[Key], finish: RowWise | None) -> DataFrame:
    # monotonically_increasing_id is the partition number above 33 bits of row position.
    marked = (
        ranged(df, keys)
        .sortWithinPartitions(*(key.sorted(key.column()) for key in keys))
        .withColumn(_MARK, F.monotonically_increasing_id())
    )
    placed = (
        marked.withColumn(_RANGE, F.shiftright(_MARK, 33).cast("int"))
        .withColumn(_SLOT, F.col(_MARK).bitwiseAND(F.lit((1 << 33) - 1)))
        .drop(_MARK)
    )
    return stage(finish(placed) if finish else placed, "ranges")


def global_ordinal(
    df: DataFrame,
    order: Sequence[Key],
    unique: Sequence[str],
    name: str = "indice",
    finish: RowWise | None = None,
) -> DataFrame:
    """Number all rows from 1 in ``order``, with ties settled by the ``unique`` columns.

    ``finish`` may add or drop columns, row by row, after the sort and before staging: columns that
    are only sorted by need not be staged, and a costly expression runs once per row.
    """
    ranges = _in_ranges(df, _total(order, unique), finish)
    earlier = Window.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    # One row per range partition: bounded by spark.sql.shuffle.partitions.
    skips = (
        ranges.groupBy(_RANGE)
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(_RANGE, F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias(_SKIP))
    )
    return (
        ranges.join(F.broadcast(skips), _RANGE)
        .withColumn(name, (F.col(_SKIP) + F.col(_SLOT) + 1).cast("long"))
        .drop(_RANGE, _SLOT, _SKIP)
    )


def _bounds(large: DataFrame, keys: Sequence[Key], rows: int, blocks: int) -> DataFrame:
    """(hash, bounds) for each large key: short keys between its blocks, in order, as rows of rows.

    ``large`` has the hash of the key beside the columns. The sample has some ``_SAMPLED`` rows per
    block, and a key's bounds are dealt in rows of about equal length to be searched in two steps.
    """
    parts = short_key(large, keys, LENGTHS[-1])
    few = large.sample(min(1.0, _SAMPLED * blocks / max(rows, 1)), seed=0).select(
        _HASH, *(value.alias(f"e{k}") for k, (_, value) in enumerate(parts))
    )
    within = Window.partitionBy(_HASH).orderBy(*(key.sorted(F.col(f"e{k}")) for k, (key, _) in enumerate(parts)))
    bound = F.struct("place", *(f"e{k}" for k in range(len(parts))))
    listed = (
        few.withColumn("place", F.row_number().over(within))
        .where(F.col("place") % _SAMPLED == 0)
        .groupBy(_HASH)
        .agg(F.array_sort(F.collect_list(bound)).alias("all"))
        .withColumn("width", F.ceil(F.sqrt(F.size("all"))).cast("int"))
    )
    cut = F.transform(
        F.sequence(F.lit(1), F.size("all"), F.col("width")), lambda at: F.slice("all", at, F.col("width"))
    )
    return listed.select(_HASH, cut.alias(_BOUNDS))


def _block_of(bounds: Column, parts: Sequence[tuple[Key, Column]]) -> Column:
    """How many bounds come before the row."""

    def before(bound: Column) -> Column:
        result = F.lit(False)
        for k, (key, value) in reversed(list(enumerate(parts))):
            mine = bound[f"e{k}"]
            result = key.precedes(mine, value) | (mine.eqNullSafe(value) & result)
        return result

    full = F.size(F.filter(bounds, lambda row: before(row[0])))
    width = F.size(bounds[0])
    last = F.size(F.filter(F.get(bounds, full - 1), before))
    return F.when(full == 0, F.lit(0)).otherwise((full - 1) * width + last)


def running_count(
    df: DataFrame,
    key: str,
    order: Sequence[Key],
    unique: Sequence[str],
    name: str = "running_count",
) -> DataFrame:
    """Count of rows so far within each key, in ``order``; NULL where the key is NULL.

    The rows are shuffled once. They are staged only if some key has too many rows for a task.
    """
    keys = _total(order, unique)
    column = F.col(f"`{key}`")
    rows, (frequent,) = _frequent(df, F.when(column.isNotNull(), F.xxhash64(column)))
    partitions = _partitions(df.sparkSession)
    # Rows without a key need no order: they are spread.
    spread = F.pmod(F.xxhash64(*(F.col(f"`{u}`") for u in unique)), F.lit(partitions)).cast("int")
    hashed = df.withColumn(_HASH, F.when(column.isNotNull(), F.xxhash64(column)))
    place = F.row_number().over(
        Window.partitionBy(key, _BLOCK).orderBy(*(k.sorted(k.column()) for k in keys))
    )
    counted = F.when(column.isNotNull(), place).cast("long")
    if not frequent:
        blocked = df.withColumn(_BLOCK, F.when(column.isNull(), spread).otherwise(F.lit(0)))
        return blocked.withColumn(name, counted).drop(_BLOCK)
    listed = df.sparkSession.createDataFrame([(h,) for h in frequent], f"{_HASH} bigint")
    held = sum(frequent.values())
    blocks = max(1, _PART * partitions * held // max(rows, 1))
    # Bounds are staged: a sample taken twice need not be the same.
    bounds = stage(_bounds(hashed.join(F.broadcast(listed), _HASH), keys, held, blocks), "bounds")
    parts = short_key(df, keys, LENGTHS[-1])
    blocked = hashed.join(F.broadcast(bounds), _HASH, "left").withColumn(
        _BLOCK,
        F.when(column.isNull(), spread)
        .when(F.col(_BOUNDS).isNotNull(), _block_of(F.col(_BOUNDS), parts) + 1)
        .otherwise(F.lit(0)),
    )
    staged = stage(blocked.drop(_BOUNDS, _HASH).withColumn(_COUNT, counted), "counted")
    earlier = Window.partitionBy(key).orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    # A row per block of the large keys.
    skips = (
        staged.where(column.isNotNull() & (F.col(_BLOCK) > 0))
        .groupBy(key, _BLOCK)
        .agg(F.max(_COUNT).alias("rows"))
        .select(key, _BLOCK, F.sum("rows").over(earlier).alias(_SKIP))
    )
    return (
        staged.join(F.broadcast(skips), [key, _BLOCK], "left")
        .withColumn(name, F.col(_COUNT) + F.coalesce(F.col(_SKIP), F.lit(0)))
        .select(*df.columns, name)
    )
