"""Contiguous shards of nearly equal bytes, by global prefix sums of row sizes; DataFrame functions only.

Rows are put in order of their key by one range shuffle and written, each with a number that holds its partition and its
place there. Totals of the partitions give prefix sums over them; only partitions in which a target falls need running
sums of their own rows. The cuts are a few rows for each partition, so every other row gets its shard without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillcast.session import materialise

#: Bytes that a row counts beside its text.
ROW_BYTES = 16
#: monotonically_increasing_id() holds the place in the partition in its lower bits.
PLACE_BITS = 33
#: The cuts are broadcast up to so many partitions, a few dozen bytes each; beyond it they are joined by shuffle.
MOST_BROADCAST = 100_000


def row_bytes(column: str) -> Column:
    """UTF-8 bytes of a text, none for null, and ``ROW_BYTES``."""
    return F.coalesce(F.octet_length(column), F.lit(0)).cast("long") + ROW_BYTES


def _hashable(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _hashable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_hashable(f.dataType) for f in kind.fields)
    return not isinstance(kind, (T.MapType, T.VariantType))


def _ordered(docs: DataFrame, key: str, size: Column, partitions: int) -> DataFrame:
    """The rows, written in order of key, hash of the row and input place; ``row`` tells partition and place.

    The place parts equal rows, so a third of all rows may be the same row: they fill many partitions.
    """
    tie = [c for c, f in zip(docs.columns, docs.schema.fields) if _hashable(f.dataType)]
    order = [F.asc_nulls_first(key), F.asc("tie"), F.asc("place")]
    marked = docs.withColumns({"size": size, "tie": F.xxhash64(*tie), "place": F.monotonically_increasing_id()})
    dealt = marked.repartitionByRange(partitions, *order).sortWithinPartitions(*order).drop("tie", "place")
    return materialise(dealt.withColumn("row", F.monotonically_increasing_id()), "shard-rows")


def _shard_of(before: str, size: str, shards: int) -> Column:
    """The shard whose share of the bytes holds the middle of a row; whole numbers of any size."""
    middle = f"(cast({before} as decimal(38, 0)) * 2 + {size}) * {shards}"
    return F.expr(f"cast(least({shards - 1}, {middle} div greatest(1, 2 * all_bytes)) as int)")


def _cuts(rows: DataFrame, shards: int) -> DataFrame:
    """For each partition: array of (first place, shard, slot of the partition's place 0), by place."""
    part = F.shiftright("row", PLACE_BITS).alias("part")
    totals = rows.groupBy(part).agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0).cast("long")
    # One row for each partition: the only step that sees them all together.
    totals = materialise(totals.select(
        "part", "bytes", F.coalesce(F.sum("bytes").over(ahead), none).alias("bytes_before"),
        F.coalesce(F.sum("n").over(ahead), none).alias("rows_before"),
        F.sum("bytes").over(Window.partitionBy(F.lit(1))).alias("all_bytes"),
    ), "shard-totals")
    ends = totals.withColumns({"low": _shard_of("bytes_before", "0", shards), "high": _shard_of("bytes_before + bytes", "0", shards)})
    whole = ends.where("low = high").select("part", "rows_before", none.alias("place"), F.col("low").alias("shard"))
    running = Window.partitionBy("part").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    inside = rows.select(part, "row", "size").join(ends.where("low < high").select("part", "bytes_before", "rows_before", "all_bytes"), "part")
    inside = inside.withColumn("before", F.col("bytes_before") + F.coalesce(F.sum("size").over(running), none))
    inside = inside.withColumn("shard", _shard_of("before", "size", shards)).groupBy("part", "rows_before", "shard").agg(
        F.min(F.col("row").bitwiseAND((1 << PLACE_BITS) - 1)).alias("place"),
    )
    pieces = whole.unionByName(inside)
    starts = pieces.groupBy("shard").agg(F.min(F.col("rows_before") + F.col("place")).alias("first_row"))
    piece = F.struct("place", "shard", (F.col("rows_before") - F.col("first_row")).alias("base"))
    return pieces.join(starts, "shard").groupBy("part").agg(F.sort_array(F.collect_list(piece)).alias("pieces"))


def assign_shards(
    docs: DataFrame, shards: int = 40, key: str = "doc_id", size: Column | None = None, column: str = "text", partitions: int | None = None,
) -> DataFrame:
    """``docs`` with size, shard (0 to ``shards`` - 1) and slot (gapless from 0 in each shard).

    Shards are contiguous in the order of ``key``, null keys first; rows of one key follow the hash of their columns,
    and equal rows their place in the input, so no key or row is too frequent. A row goes to the shard in whose share of all bytes
    its middle lies: a shard's bytes differ from the share by at most one row's. So a row beyond a share may leave
    neighbours empty. A null text has ``ROW_BYTES``; an empty table gives an empty result. New columns replace
    those of the same name. ``size`` may be any column expression of whole numbers, 0 or more.
    """
    if shards < 1:
        raise ValueError("shards must be 1 or more")
    spark = docs.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    given = docs.withColumn("size", row_bytes(column) if size is None else size.cast("long"))
    kept = [c for c in given.columns if c not in ("size", "shard", "slot")]
    own = [f"_{i}" for i in range(len(kept))]
    rows = _ordered(given.select(*kept, "size").toDF(*own, "size"), own[kept.index(key)], F.col("size"), partitions)
    cuts = materialise(_cuts(rows, shards), "shard-cuts")
    place = F.col("row").bitwiseAND((1 << PLACE_BITS) - 1)
    found = rows.withColumns({"part": F.shiftright("row", PLACE_BITS), "place": place})
    found = found.join(F.broadcast(cuts) if partitions <= MOST_BROADCAST else cuts, "part")
    piece = F.element_at(F.filter("pieces", lambda p: p["place"] <= F.col("place")), -1)
    found = found.withColumn("piece", piece).select(
        *own, "size", F.col("piece.shard").alias("shard"), (F.col("piece.base") + F.col("place")).alias("slot"),
    )
    return found.toDF(*kept, "size", "shard", "slot")


def write_shards(docs: DataFrame, folder: str, **options) -> DataFrame:
    """Writes the sharded rows as Parquet, one folder ``shard=N`` for each shard, and reads them back.

    Rows come from the ordered table, so a task writes the one or two shards that its rows fall into.
    """
    assign_shards(docs, **options).write.partitionBy("shard").parquet(folder)
    return docs.sparkSession.read.parquet(folder)
