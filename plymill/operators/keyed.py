"""Keyed building blocks: dedupe, sampled ranges, running totals, row numbers, exact splits and samples.

All of them reduce rows before the shuffle, so one key with a large share of
the rows costs one row per map task and not one overfull task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plymill.session import scratch_path


def dedupe(df: DataFrame, key: str, count_as: str | None = None) -> DataFrame:
    """One row per key: the smallest row, comparing the other columns in order, nulls first.

    ``min`` over a struct is aggregated map-side first; the copies of a hot
    key never meet in one window.
    """
    others = [name for name in df.columns if name != key]
    smallest = F.min(F.struct(*others)).alias("row")
    counted = [F.count("*").alias(count_as)] if count_as else []
    kept = df.groupBy(key).agg(smallest, *counted)
    columns = [F.col(key) if name == key else F.col(f"row.{name}").alias(name) for name in df.columns]
    return kept.select(*columns, *([count_as] if count_as else []))


def heaviest(value: str, weight: str) -> Column:
    """Aggregate that ends a two-step mode: the value of largest weight, smallest on ties, nulls ignored.

    The first step counts per (key, value), so no aggregate buffer holds the
    distinct values of a hot key.
    """
    ranked = F.struct((-F.col(weight)).alias("w"), F.col(value).alias("v"))
    return F.min(F.when(F.col(value).isNotNull(), ranked))["v"]


def ranges(df: DataFrame, *order: str | Column, parts: int | None = None, label: str = "ranges") -> DataFrame:
    """``df`` written in ranges of ``order``, with the number of its range as ``_range``.

    Spark samples the values to cut the ranges, so each holds about the same number of rows,
    whatever the distribution; only rows equal in all of ``order`` cannot be parted.  The
    written table makes the cut final: sampling again could cut elsewhere.
    """
    spark = df.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, label)
    df.repartitionByRange(parts, *order).withColumn("_range", F.spark_partition_id()).write.parquet(path)
    return spark.read.parquet(path)


def running_totals(df: DataFrame, group: list[str], position: str, values: list[str], parts: int | None = None) -> DataFrame:
    """Running sums of ``values`` by ascending ``position`` within each group.

    A plain window would sort a whole group in one task.  Instead the rows are cut into
    sampled ranges of (group, position), the totals of the ranges are summed up, and the rows themselves only
    inside their range.  ``position`` must be distinct per group (aggregate first).
    Adds ``<value>_before`` and ``<value>_upto``; rows without a position drop.
    """
    placed = ranges(df.filter(F.col(position).isNotNull()), *group, position, parts=parts)
    totals = placed.groupBy(*group, "_range").agg(*[F.sum(v).alias(f"_{v}") for v in values])
    # a group has at most one total per range; without a group they all meet in one small window
    own = Window.partitionBy(*(group or [F.lit(0)]))
    earlier = own.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(g).alias(f"_of_{g}") for g in group],
        F.col("_range").alias("_of"),
        *[F.coalesce(F.sum(f"_{v}").over(earlier), F.lit(0)).alias(f"_{v}_offset") for v in values],
    )
    same = F.col("_range") == F.col("_of")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_of_{g}"))
    inside = Window.partitionBy(*group, "_range").orderBy(position).rowsBetween(Window.unboundedPreceding, 0)
    summed = placed.join(offsets, same)
    upto = {f"{v}_upto": F.col(f"_{v}_offset") + F.sum(v).over(inside) for v in values}
    summed = summed.withColumns(upto).withColumns({f"{v}_before": F.col(f"{v}_upto") - F.col(v) for v in values})
    return summed.select(*df.columns, *[f"{v}_{side}" for v in values for side in ("before", "upto")])


def numbered(df: DataFrame, order: list[Column], name: str = "number", parts: int | None = None) -> DataFrame:
    """``df`` with 0-based row numbers in ``order``, as one global sort would give them.

    Rows are numbered inside sampled ranges, and the ranges' row counts add up to their offsets,
    so no task holds more than a range.
    """
    placed = ranges(df, *order, parts=parts, label="numbered")
    sizes = placed.groupBy("_range").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy(F.lit(0)).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(F.col("_range").alias("_of"), F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    rank = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    found = placed.join(offsets, F.col("_range") == F.col("_of"))
    return found.withColumn(name, F.col("_offset") + rank - 1).select(*df.columns, name)


def exact_medians(df: DataFrame, columns: list[str]) -> DataFrame:
    """Exact median of every numeric column, as rows (feature, median).

    Values are counted first, so the ordering works on distinct values only.
    """
    doubles = df.select(*[F.col(name).cast("double").alias(name) for name in columns])
    long = doubles.unpivot([], columns, "feature", "value").filter(F.col("value").isNotNull())
    counted = long.groupBy("feature", "value").agg(F.count("*").alias("n"))
    sizes = counted.groupBy("feature").agg(F.sum("n").alias("total"))
    # one row per named column, so it is safe to broadcast; a shuffle by feature would be all skew
    ranked = running_totals(counted, ["feature"], "value", ["n"]).join(F.broadcast(sizes), "feature")
    # 0-based ranks of the two middle rows
    low, high = F.floor((F.col("total") - 1) / 2), F.floor(F.col("total") / 2)

    def holds(rank: Column) -> Column:
        return (F.col("n_before") <= rank) & (rank < F.col("n_upto"))

    return ranked.groupBy("feature").agg(
        (
            (F.max(F.when(holds(low), F.col("value"))) + F.max(F.when(holds(high), F.col("value")))) / 2
        ).alias("median")
    )


def hash_order(key: Column, seed: int) -> Column:
    """A repeatable pseudo-random order of keys, the same on every layout and engine."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), key.cast("string")))


def hash_fraction(key: Column, seed: int) -> Column:
    """The hash of a key as a number in [0, 1)."""
    return F.conv(F.substring(hash_order(key, seed), 1, 8), 16, 10).cast("double") / F.lit(float(2**32))


def hash_sample(df: DataFrame, key: str, fraction: float, seed: int = 42) -> DataFrame:
    """Keep the keys whose hash falls below ``fraction``; independent of partitioning."""
    check_fraction(fraction)
    return df.filter(hash_fraction(F.col(key), seed) < fraction)


def check_fraction(fraction: float) -> None:
    if not 0 < fraction <= 1:
        raise ValueError("fraction must be in the range (0, 1]")


def stratified_split(df: DataFrame, label: str, key: str, test_share: float = 0.2, seed: int = 42) -> DataFrame:
    """Adds ``is_test``: exactly ``round(test_share * n)`` rows of every class, by key hash.

    The rows are written once with their hash.  Counts by the first four digits of the hash find the
    slot that holds a class's cut, counts by the next four narrow it down, and the
    few rows left give the exact (hash, key) at the cut.  Whether a row is a test row
    is then one comparison, in one pass over the written rows.  Rows with equal keys in a class fall on one side.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "split")
    df.withColumn("_h", hash_order(F.col(key), seed)).write.parquet(path)
    hashed = spark.read.parquet(path)
    order = F.struct(F.col("_h"), F.col(key).alias("key"))

    def with_class(table: DataFrame) -> DataFrame:
        """The rows with ``_c``, the row of ``table`` for their class; one row per class, so it is looked up in an array."""
        rows = hashed.withColumn("_rows", table.agg(F.collect_list(F.struct(*table.columns)).alias("rows")).scalar())
        own = F.filter("_rows", lambda row: row["_label"].eqNullSafe(F.col(label)))
        return rows.withColumn("_c", F.get(own, F.lit(0)))

    wanted = hashed.groupBy(F.col(label).alias("_label")).agg(F.round(F.count("*") * F.lit(test_share)).cast("bigint").alias("_left"))
    cut = wanted.filter("_left > 0").withColumn("_slot", F.lit(""))
    for digits in (4, 8):
        near = with_class(cut).filter(F.startswith("_h", F.col("_c._slot")))
        counts = near.groupBy(F.col(label).alias("_label"), F.substring("_h", 1, digits).alias("_next")).agg(
            F.count("*").alias("_n"), F.min("_c._left").alias("_left")
        )
        upto = F.sum("_n").over(Window.partitionBy("_label").orderBy("_next"))
        placed = counts.withColumns({"_upto": upto, "_before": upto - F.col("_n")})
        holds = (F.col("_before") < F.col("_left")) & (F.col("_left") <= F.col("_upto"))
        cut = placed.filter(holds).select("_label", (F.col("_left") - F.col("_before")).alias("_left"), F.col("_next").alias("_slot"))
    last = with_class(cut).filter(F.startswith("_h", F.col("_c._slot")))
    rank = F.row_number().over(Window.partitionBy(label).orderBy("_h", key))
    last = last.withColumn("_rank", rank).filter("_rank = _c._left")
    cuts = last.select(F.col(label).alias("_label"), order.alias("_cut"))
    is_test = F.coalesce(order <= F.col("_c._cut"), F.lit(False))
    return with_class(cuts).select(*df.columns, is_test.alias("is_test"))


def stratified_sample(df: DataFrame, label: str, key: str, share: float, seed: int = 42) -> DataFrame:
    """The rows that ``stratified_split`` marks, for a small share: exactly ``round(share * n)`` of every class.

    Counts by the first four digits of the hash find the slot that holds a class's cut.  Only rows up to that slot are
    written; the cut inside it is exact.  So ``df`` is passed over twice, and none of the other rows is written.
    """
    hashed = df.withColumn("_h", hash_order(F.col(key), seed))
    slot = F.substring("_h", 1, 4)
    counts = hashed.groupBy(F.col(label).alias("_label"), slot.alias("_slot")).agg(F.count("*").alias("_n"))
    own = Window.partitionBy("_label")
    wanted = F.round(F.sum("_n").over(own) * F.lit(share)).cast("bigint")
    placed = counts.withColumns({"_wanted": wanted, "_before": F.sum("_n").over(own.orderBy("_slot")) - F.col("_n")})
    holds = (F.col("_before") < F.col("_wanted")) & (F.col("_wanted") <= F.col("_before") + F.col("_n"))
    ends = placed.filter(holds).select("_label", "_slot", (F.col("_wanted") - F.col("_before")).alias("_left"))
    # one row per class, so it is looked up in an array
    listed = ends.agg(F.collect_list(F.struct(*ends.columns)).alias("rows")).scalar()
    same = F.filter("_rows", lambda row: row["_label"].eqNullSafe(F.col(label)))
    near = hashed.withColumn("_rows", listed).withColumn("_c", F.get(same, F.lit(0))).filter(slot <= F.col("_c._slot"))
    path = scratch_path(df.sparkSession, "sample")
    near.drop("_rows").write.parquet(path)
    near = df.sparkSession.read.parquet(path)
    # rows with equal keys in a class fall on one side
    rank = F.rank().over(Window.partitionBy(label).orderBy("_h", key))
    last = near.filter(slot == F.col("_c._slot")).withColumn("_rank", rank).filter("_rank <= _c._left")
    return near.filter(slot < F.col("_c._slot")).unionByName(last.drop("_rank")).select(*df.columns)


def any_of(*conditions: Column) -> Column:
    return reduce(lambda left, right: left | right, conditions)
