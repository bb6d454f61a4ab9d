"""Small shared helpers: look-ups that no frequent key can skew, vector sums and a
distributed global rank."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, ship_package, stored
from .textscan import fill, look_up, slices

HOT_KEYS = 100_000
HOT_BYTES = 256


def _hot_and_cold(table: DataFrame, key: str, value: str, weight: str) -> tuple[DataFrame, DataFrame]:
    """table(key, value) in two parts: the HOT_KEYS rows of greatest weight with
    a key and a value of at most HOT_BYTES each, some 50 MB at most, and the rest."""
    table = cut_lineage(table.select(key, F.col(value).alias("_v"), F.col(weight).alias("_n")).where(F.col(key).isNotNull()))
    size = lambda c: F.octet_length(F.col(c).cast("string"))
    short = table.where((size(key) <= HOT_BYTES) & (size("_v") <= HOT_BYTES))
    hot = short.orderBy(F.col("_n").desc(), key).limit(HOT_KEYS).select(key, "_v")
    cold = table.join(F.broadcast(hot.select(key)), key, "left_anti").select(key, "_v")
    return hot, cold


def split_lookup(rows: DataFrame, key: str, items: str, table: DataFrame, item: str, value: str, weight: str, within: str | None = None) -> DataFrame:
    """rows(key, items) -> (key, found): the items of every row looked up in
    table(item, value, weight), as an array in their order; null for an item that
    the table lacks. A null array has no items. The items of the table are unique,
    rows need not be.

    Frequent items would make a shuffle join lopsided, so the heaviest rows of
    the table are broadcast, within a fixed bound, and looked up where the rows
    are read. What is stored lies below ``within``, if given. The other items are shuffled once per distinct (row, item), with
    their places; the rows are stored and shuffled once, as found."""
    spark = rows.sparkSession
    hot, cold = _hot_and_cold(table, item, value, weight)
    heavy = spark.sparkContext.broadcast(hot.toArrow().combine_chunks())
    ship_package(spark)
    kinds = {f.name: f.dataType.simpleString() for f in table.schema.fields}

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = heavy.value.column(item).combine_chunks()
        values = heavy.value.column("_v").combine_chunks()
        for batch in batches:
            column = batch.column(2)
            for at, end in slices(_sizes(column)):
                part = column.slice(at, end - at)
                got, rest = look_up(_sizes(part), part.flatten(), keys, values, item)
                row = [c.slice(at, end - at) for c in batch.columns[:2]]
                yield pa.RecordBatch.from_arrays([*row, got, rest], ["_row", key, "_near", "_rest"])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), fill(batch.column(1), batch.column(2))], [key, "found"])

    numbered = rows.select(F.monotonically_increasing_id().alias("_row"), key, items)
    kind = f"`{key}` {rows.schema[key].dataType.simpleString()}"
    lists = f"_near array<{kinds[value]}>, _rest array<struct<pos:int,`{item}`:{kinds[item]}>>"
    base = stored(numbered.mapInArrow(near, f"_row bigint, {kind}, {lists}"), "lookup", *([within] if within else []))
    rest = base.select("_row", F.explode("_rest").alias("_x")).select("_row", "_x.*")
    far = rest.groupBy("_row", item).agg(F.collect_list("pos").alias("_at")).join(cold, item, "left")
    far = far.select("_row", F.explode("_at").alias("pos"), "_v")
    far = far.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("pos", "_v"))).alias("_far"))
    far = far.select("_row", F.transform("_far", lambda x: x["_v"]).alias("_far"))
    none = F.array().cast(f"array<{kinds[value]}>")
    both = base.select("_row", key, "_near").join(far, "_row", "left").select(key, "_near", F.coalesce("_far", none).alias("_far"))
    return both.mapInArrow(whole, f"{kind}, found array<{kinds[value]}>")


def _sizes(column: pa.Array) -> np.ndarray:
    """Elements of each list; 0 for null."""
    return pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def split_join(df: DataFrame, table: DataFrame, key: str, value: str, weight: str) -> DataFrame:
    """df with the column ``value`` of table(key, value, weight), null where it
    has none: rows of heavy keys meet a bounded broadcast, the others are shuffled."""
    hot, cold = _hot_and_cold(table, key, value, weight)
    marked = stored(df.join(F.broadcast(hot.withColumn("_hot", F.lit(True))), key, "left"), "lookup")
    near = marked.where("_hot").withColumnRenamed("_v", value)
    far = marked.where("_hot IS NULL").drop("_v").join(cold.withColumnRenamed("_v", value), key, "left")
    return near.unionByName(far).select(*df.columns, value)


def global_rank(df: DataFrame, order_cols: list[str | Column], name: str = "rank", start: int = 1) -> DataFrame:
    """Dense 0..n-1 (+start) rank of ``df`` by a total order, without pulling
    the rows into one partition.

    Range-partition and sort by the key, freeze the partitions with a reliable
    checkpoint, count rows per partition (one row per partition reaches a
    small window), and add each partition's prefix offset to the row's ordinal
    inside the partition (the low 33 bits of monotonically_increasing_id).
    The order must be total (unique keys) for the result to be deterministic.
    """
    ordered = cut_lineage(df.repartitionByRange(*order_cols).sortWithinPartitions(*order_cols))
    tagged = ordered.withColumn("_pid", F.spark_partition_id()).withColumn("_mid", F.monotonically_increasing_id())
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    offsets = counts.select(
        "_pid",
        F.coalesce(
            F.sum("_cnt").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("_off"),
    )
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("bigint"), 33)
    return (
        tagged.join(F.broadcast(offsets), "_pid")
        .withColumn(name, (F.col("_off") + local + F.lit(start)).cast("bigint"))
        .drop("_pid", "_mid", "_off")
    )


def global_prefix_sum(df: DataFrame, order_cols: list[str], value: str, name: str = "offset") -> DataFrame:
    """Exclusive running sum of ``value`` over a total order, distributed.

    Same scheme as ``global_rank``: frozen range partitions, one total per
    partition (a small window over partition ids), then a running sum inside
    each partition.
    """
    ordered = cut_lineage(df.repartitionByRange(*order_cols).sortWithinPartitions(*order_cols))
    tagged = ordered.withColumn("_pid", F.spark_partition_id())
    totals = tagged.groupBy("_pid").agg(F.sum(value).alias("_tot"))
    offsets = totals.select(
        "_pid",
        F.coalesce(
            F.sum("_tot").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("_off"),
    )
    inner = Window.partitionBy("_pid").orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, -1)
    return (
        tagged.withColumn("_run", F.coalesce(F.sum(value).over(inner), F.lit(0)))
        .join(F.broadcast(offsets), "_pid")
        .withColumn(name, (F.col("_off") + F.col("_run")).cast("bigint"))
        .drop("_pid", "_off", "_run")
    )


SUMS = 64  # vector positions summed side by side


def add_vectors(df: DataFrame, keys: list[str], col: str = "vec") -> DataFrame:
    """Element-wise sums of the vectors of each group: keys, col. Vectors go in
    pieces of SUMS positions, each piece as so many plain sums, which Spark
    combines map-side: a group holds one piece at a time, however many vectors
    it has. A shorter vector adds nothing to the positions it lacks; a null one
    adds nothing at all."""
    piece = F.col("__k") * SUMS
    at = df.where(F.col(col).isNotNull()).withColumn("__k", F.explode(F.sequence(F.lit(0), F.greatest(F.floor((F.size(col) - 1) / SUMS), F.lit(0)))))
    cells = [F.sum(F.get(col, (piece + i).cast("int"))).alias(f"__s{i}") for i in range(SUMS)]
    size = F.max(F.least(F.size(col) - piece, F.lit(SUMS))).alias("__n")
    sums = at.groupBy(*keys, "__k").agg(size, *cells)
    part = F.slice(F.array(*[F.col(f"__s{i}") for i in range(SUMS)]), F.lit(1), F.greatest(F.col("__n"), F.lit(0)).cast("int"))
    pieces = sums.select(*keys, F.struct("__k", part.alias("v")).alias("__p"))
    # At most one piece per SUMS positions of a row of the model.
    whole = F.flatten(F.transform(F.array_sort(F.collect_list("__p")), lambda p: p["v"]))
    return pieces.groupBy(*keys).agg(whole.alias(col))
