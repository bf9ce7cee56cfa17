"""Sharding by jump consistent hashing, without Python on the executors.

A key walks through ever longer jumps of a 64-bit linear congruential generator; the last jump below the
number of shards is its shard. One more shard takes keys only into itself, an expected 1/(n+1) of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import checkpointed, free_name

#: The published multiplier of the generator, 2862933555777941757, as 32-bit halves, and their 16-bit parts.
_MULTIPLIER = 2862933555777941757
_HIGH, _LOW = _MULTIPLIER >> 32, _MULTIPLIER & 0xFFFFFFFF
_MASK = 0xFFFFFFFF
_BLOCK = 16


def _times(a: Column, b: int) -> Column:
    """a * b modulo 2**32, for 32-bit values, never beyond 63 bits."""
    low, high = b & 0xFFFF, b >> 16
    return (a * F.lit(low) + F.shiftleft((a * F.lit(high)).bitwiseAND(F.lit(0xFFFF)), 16)).bitwiseAND(F.lit(_MASK))


def _next(s: Column) -> tuple[Column, Column]:
    """The generator's next state, state * multiplier + 1 modulo 2**64, in 32-bit halves (no overflow under ANSI rules)."""
    hi, lo = s["hi"], s["lo"]
    upper = lo * F.lit(_LOW >> 16)
    lower = lo * F.lit(_LOW & 0xFFFF) + F.lit(1) + F.shiftleft(upper.bitwiseAND(F.lit(0xFFFF)), 16)
    carry = F.shiftright(lower, 32) + F.shiftright(upper, 16)
    high = (carry + _times(lo, _HIGH) + _times(hi, _LOW)).bitwiseAND(F.lit(_MASK))
    return high, lower.bitwiseAND(F.lit(_MASK))


def jump_shards(key: Column, shards: int) -> Column:
    """``struct(shard int, grown_shard int)``: the key's shard among ``shards`` and among one more. Null keys count as 0."""
    if not 0 < shards < 1 << 31:
        raise ValueError("shards must be a positive number below 2**31")
    key = F.coalesce(key.cast("long"), F.lit(0).cast("long"))
    wide = F.lit(shards).cast("long")
    start = F.struct(
        F.shiftrightunsigned(key, 32).alias("hi"), key.bitwiseAND(F.lit(_MASK)).alias("lo"),
        F.lit(-1).cast("long").alias("b"), F.lit(0).cast("long").alias("j"),
    )

    def step(s: Column, _: Column) -> Column:
        high, low = _next(s)
        share = F.lit(float(1 << 31)) / (F.shiftright(high, 1) + F.lit(1)).cast("double")
        jump = ((s["j"] + F.lit(1)).cast("double") * share).cast("long")
        moved = F.struct(high.alias("hi"), low.alias("lo"), s["j"].alias("b"), jump.alias("j"))
        return F.when(s["j"] < wide, moved).otherwise(s)

    # Jumps grow, so there are at most as many as shards; blocks of steps that are not needed cost one comparison.
    blocks = -(-shards // _BLOCK)
    end = F.aggregate(
        F.sequence(F.lit(1), F.lit(blocks)),
        start,
        lambda s, _: F.when(s["j"] < wide, F.aggregate(F.sequence(F.lit(1), F.lit(_BLOCK)), s, step)).otherwise(s),
    )
    return F.aggregate(
        F.array(end),
        F.struct(F.lit(0).alias("shard"), F.lit(0).alias("grown_shard")),
        lambda _, s: F.struct(
            s["b"].cast("int").alias("shard"), F.when(s["j"] == wide, wide).otherwise(s["b"]).cast("int").alias("grown_shard")
        ),
    )


def with_slots(df: DataFrame, group: str, slot: str = "slot", buckets: int = 1024) -> DataFrame:
    """Adds ``slot``: a gapless number from 0 within each group, whatever the groups' sizes.

    Rows are dealt into ``buckets`` per group by a number that a checkpoint fixes; a bucket starts
    where those before it end. The table of starts has at most groups x buckets rows, so it is broadcast
    only where the groups are as few as shards.
    """
    row, bucket, size, start = (free_name(df.columns, n) for n in ("_row", "_bucket", "_size", "_start"))
    fixed = checkpointed(df.withColumn(row, F.monotonically_increasing_id()))
    dealt = fixed.withColumn(bucket, F.pmod(F.xxhash64(row), F.lit(buckets)))
    sizes = dealt.groupBy(group, bucket).agg(F.count("*").alias(size))
    before = Window.partitionBy(group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(group, bucket, F.coalesce(F.sum(size).over(before), F.lit(0)).alias(start))
    inside = Window.partitionBy(group, bucket).orderBy(row)
    numbered = dealt.join(F.broadcast(starts), [group, bucket])
    return numbered.select(*df.columns, (F.row_number().over(inside) - 1 + F.col(start)).cast("long").alias(slot))


def shard(df: DataFrame, key: str = "doc_id", shards: int = 16, buckets: int = 1024) -> DataFrame:
    """Adds ``shard``, ``grown_shard`` (with one shard more) and ``slot``; every row and column is kept.

    The law is ``key``: the key and the number of shards alone decide. Null keys go where key 0 goes. Equal and
    repeated rows each get a slot of their own. An empty table gives an empty one. Columns already named like the
    new ones are replaced.
    """
    kept = [c for c in df.columns if c.lower() not in ("shard", "grown_shard", "slot")]
    jump = free_name(kept, "_jump")
    placed = df.select(*kept, jump_shards(df[key], shards).alias(jump)).select(*kept, f"{jump}.shard", f"{jump}.grown_shard")
    return with_slots(placed, "shard", buckets=buckets)


def text_digest(text: Column) -> tuple[Column, Column]:
    """(UTF-8 bytes plus 1, unsigned CRC-32); null counts as no bytes."""
    data = F.coalesce(text, F.lit("")).cast("binary")
    return (F.octet_length(data) + 1).cast("long"), F.crc32(data).cast("long")
