"""Bloom filters of natural keys, one per stored part of a fact, built and probed with built-in functions.

A part's filter is a table of blocks of ``HASHES`` bitmaps of 32,768 bits. A key belongs to one block and sets one bit in each of its
bitmaps, so a probe reads one row. A filter never misses a key; with ``BITS_A_KEY`` bits it takes a strange key for one of its own in
about one of 25,000 cases. The least and greatest first key column of a part are kept too and rule out parts before any filter is read.

A key travels once, as its 64-bit hash: bits are taken from the hash inside the aggregate and after the join, so neither a sort nor a
shuffle holds a row per bit.

A key set of another shape serves a join inside one plan: ``likely`` drops rows whose key is surely not among some others before they move.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITMAP_BITS = 1 << 15
HASHES = 8
BITS_A_KEY = 24
BITMAPS = [f"bits{i}" for i in range(HASHES)]
FILTER_SCHEMA = ", ".join(["part string", "block long", *[f"{name} binary" for name in BITMAPS]])


def blocks_for(keys: int) -> int:
    return max(1, -(-keys * BITS_A_KEY // (HASHES * BITMAP_BITS)))


def _bit(i: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(i), "_hash"), F.lit(BITMAP_BITS)).cast("int")


def _is_set(bitmap: Column, bit: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, bit % 8) == 1


def build(rows: DataFrame, period: str, prefix: str, keys: list[Column], blocks: dict[int, int]) -> DataFrame:
    """A row ``part, block`` and the bitmaps for each block of some parts; ``blocks`` gives the number of blocks of each value of column ``period``.

    The rows of a block meet before they are aggregated: bitmaps filled in part by every task would be as many as blocks times tasks.
    """
    sizes = F.create_map(*[F.lit(v) for pair in blocks.items() for v in pair])
    hashed = rows.select(F.col(period).alias("_period"), F.xxhash64(*keys).alias("_hash"))
    placed = hashed.withColumn("block", F.pmod("_hash", F.element_at(sizes, F.col("_period"))).cast("long")).repartition("_period", "block")
    filled = placed.groupBy("_period", "block").agg(*[F.bitmap_construct_agg(_bit(i)).alias(name) for i, name in enumerate(BITMAPS)])
    return filled.select(F.concat(F.lit(prefix), F.col("_period").cast("string")).alias("part"), "block", *BITMAPS)


def probe(rows: DataFrame, keys: list[Column], parts: list[dict], filters: DataFrame, one_in: int = 1) -> DataFrame:
    """One row ``part, hits`` for every part that may hold some of the keys, or some of one in ``one_in`` keys.

    ``parts`` lists ``part, blocks, low, high`` of every part, a few for each stored folder; ``filters`` has their blocks.
    """
    listed = F.array(*[F.struct(F.lit(i).alias("number"), F.lit(p["blocks"]).alias("blocks"), F.lit(p["low"]).alias("low"), F.lit(p["high"]).alias("high")) for i, p in enumerate(parts)])
    numbers = F.create_map(*[F.lit(v) for i, p in enumerate(parts) for v in (p["part"], i)])
    hashed = rows.select(keys[0].alias("_first"), F.xxhash64(*keys).alias("_hash"))
    if one_in > 1:
        hashed = hashed.where(F.pmod(F.xxhash64(F.lit(HASHES), "_hash"), F.lit(one_in)) == 0)
    asked = hashed.select("_first", "_hash", F.explode(listed).alias("_in")).where(F.col("_first").between(F.col("_in.low"), F.col("_in.high")))
    asked = asked.select(F.col("_in.number").alias("_number"), F.pmod("_hash", F.col("_in.blocks")).cast("long").alias("block"), "_hash")
    stored = filters.where(F.col("part").isin([p["part"] for p in parts])).withColumn("_number", F.element_at(numbers, F.col("part")))

    # A key is asked of every part, which no size estimate knows of: both sides are shuffled, never broadcast.
    met = asked.hint("merge").join(stored, ["_number", "block"])
    for i, bitmap in enumerate(BITMAPS):
        met = met.where(_is_set(F.col(bitmap), _bit(i)))
    return met.groupBy("part").agg(F.count(F.lit(1)).alias("hits"))


SET_BLOCKS = 1 << 12
WORTH_A_SET = 64 << 20  # bytes: smaller tables are moved sooner than a set is built


def _set_bit(key: Column) -> Column:
    """Bit of a key in a key set."""
    return F.pmod(F.xxhash64(key), F.lit(SET_BLOCKS * BITMAP_BITS))


def _size(df: DataFrame) -> int:
    """Bytes that Spark expects; the largest number where it knows none."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def likely(rows: DataFrame, others: DataFrame, key: str, least: int = WORTH_A_SET) -> DataFrame:
    """The rows whose ``key`` may be one of ``others``: all that are, and some that are not. The join that decides comes later.

    The others become one bitmap of fixed size (16 MB), whatever their number: it takes a strange key for one of 18 million with 13 %. A plan
    computes it before its other stages and tests rows where it reads them, also below a window partitioned by ``key``: a filter on the keys of
    a window moves below it, a join does not. Rows of less than ``least`` bytes, or of a size that Spark does not know, come back untested.
    """
    if not least <= _size(rows) < 1 << 60:
        return rows
    bit = _set_bit(F.col(key))
    # A key's bit meets those of its block before they are set: bitmaps filled in part by every task would be as many as blocks times tasks.
    placed = others.where(F.col(key).isNotNull()).select(F.floor(bit / BITMAP_BITS).alias("_block"), (bit % BITMAP_BITS).cast("int").alias("_bit")).repartition("_block")
    blocks = placed.groupBy("_block").agg(F.hex(F.bitmap_construct_agg("_bit")).alias("_bits"))
    held = blocks.agg(F.map_from_entries(F.collect_list(F.struct("_block", "_bits"))).alias("_held"))
    none = F.lit("00" * (BITMAP_BITS // 8))
    every = F.transform(F.sequence(F.lit(0).cast("long"), F.lit(SET_BLOCKS - 1).cast("long")), lambda i: F.coalesce(F.element_at("_held", i), none))
    whole = held.select(F.unhex(F.array_join(every, "")).alias("_set"))
    return rows.where(_is_set(whole.scalar(), bit))
