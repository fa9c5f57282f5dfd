"""Sharding by a permutation-filled lookup table.

Every shard has its own order of preference over the slots of a table of prime
size. The shards take turns, each claiming the first slot of its order that is
still free, until the table is full. Keys hash to slots, so a key finds its shard
in constant time, shards differ by at most one slot, and a table for one shard
more or less moves few other keys.

The table has ``slots`` rows whatever the data: it is a parameter, bounded by
``MOST_SLOTS``, and is the only thing that is broadcast.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MOST_SLOTS = 65_537


def preference(shard: str, slots: int, seed: int) -> tuple[int, int]:
    """First slot and stride of a shard's order of preference."""
    digest = hashlib.md5(f"{seed}:{shard}".encode()).hexdigest()
    return int(digest[:15], 16) % slots, int(digest[15:30], 16) % (slots - 1) + 1


def fill_table(shards: Sequence[str], slots: int, seed: int = 0) -> list[int]:
    """The owner of every slot, as a position in ``shards``."""
    if len(set(shards)) != len(shards) or not shards:
        raise ValueError("shard names must be distinct, and at least one")
    if not len(shards) <= slots <= MOST_SLOTS:
        raise ValueError(f"slots must be from the number of shards to {MOST_SLOTS}")
    if slots < 2 or any(slots % k == 0 for k in range(2, int(slots**0.5) + 1)):
        raise ValueError("slots must be prime, else strides miss slots")
    owner = [-1] * slots
    at, stride = map(list, zip(*(preference(s, slots, seed) for s in shards), strict=True))
    for turn in range(slots):
        i = turn % len(shards)
        while owner[at[i]] >= 0:
            at[i] = (at[i] + stride[i]) % slots
        owner[at[i]] = i
    return owner


def table_frame(spark: SparkSession, owner: Sequence[int]) -> DataFrame:
    """The table as (slot int, shard int)."""
    text = F.lit(",".join(map(str, owner)))
    cells = spark.range(1).select(F.posexplode(F.split(text, ",")).alias("slot", "shard"))
    return cells.withColumn("shard", F.col("shard").cast("int"))


def slot_of(key: Column, slots: int) -> Column:
    """The key's slot; a null key counts as the empty text."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    number = F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")
    return F.pmod(number, F.lit(slots)).cast("int")


def place(
    df: DataFrame,
    shards: Sequence[str],
    slots: int,
    key: str = "doc_id",
    seed: int = 0,
    slot_column: str = "slot",
    shard_column: str = "shard",
) -> DataFrame:
    """Add the slot and the shard of every row; no row is lost or moved by a shuffle.

    Rows with equal keys, null keys among them, go to one shard. Columns of the
    frame that bear the names of the two new ones are replaced. An empty frame
    stays empty.
    """
    kept = [c for c in df.columns if c not in (slot_column, shard_column)]
    cells = table_frame(df.sparkSession, fill_table(shards, slots, seed))
    cells = cells.select(F.col("slot").alias("__slot"), F.col("shard").alias("__shard"))
    row = F.struct(*[F.col(f"`{c}`") for c in kept]).alias("__row")
    keyed = df.select(row, slot_of(F.col(key), slots).alias("__at"))
    return keyed.join(F.broadcast(cells), F.col("__at") == F.col("__slot")).select(
        "__row.*",
        F.col("__at").alias(slot_column),
        F.col("__shard").alias(shard_column),
    )


def write_shards(placed: DataFrame, path: str, files_per_shard: int = 1) -> None:
    """One folder for each shard. A shard is dealt over ``files_per_shard`` tasks."""
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in placed.columns]), F.lit(files_per_shard))
    placed.repartition("shard", salt).write.partitionBy("shard").parquet(path)


def oracle_sql(n_shards: int, slots: int, seed: int = 0) -> str:
    """The table filled turn by turn in a recursive query, and every document looked up."""
    number = "CAST('0x' || substr({0}, {1}, 15) AS BIGINT)"
    digest = f"md5('{seed}:' || i)"
    return f"""
WITH RECURSIVE pref AS MATERIALIZED (
  SELECT list({number.format(digest, 1)} % {slots} ORDER BY i) AS first,
         list({number.format(digest, 16)} % {slots - 1} + 1 ORDER BY i) AS stride
  FROM range({n_shards}) t(i)),
fill AS (
  SELECT 0 AS turn, CAST(NULL AS BIGINT) AS slot, list_transform(range({slots}), lambda x: false) AS taken
  UNION ALL
  SELECT turn + 1, slot, list_transform(taken, lambda x, k: x OR k = slot + 1)
  FROM (SELECT turn, taken, (first[turn % {n_shards} + 1] + stride[turn % {n_shards} + 1]
      * list_filter(range({slots}), lambda j: NOT taken[(first[turn % {n_shards} + 1]
        + j * stride[turn % {n_shards} + 1]) % {slots} + 1])[1]) % {slots} AS slot
    FROM fill, pref WHERE turn < {slots})),
cells AS (SELECT slot, (turn - 1) % {n_shards} AS shard FROM fill WHERE turn > 0)
SELECT d.*, CAST(c.slot AS INTEGER) AS slot, CAST(c.shard AS INTEGER) AS shard
FROM (SELECT doc_id FROM documents) d JOIN cells c
  ON c.slot = {number.format("md5(coalesce(CAST(doc_id AS VARCHAR), ''))", 1)} % {slots}
"""
