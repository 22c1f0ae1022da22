"""Sharding by a pseudo-random permutation of global row numbers.

A Feistel network is a bijection of [0, 2^bits). Cycle walking, that is applying it again
while the image is not below n, makes it a bijection of [0, n). Row number r then goes to
place p = walk(r), shard p mod shards and slot p div shards: shard sizes differ by one at
most, slots have no gap, and both are computed from r alone. The network runs backwards as
well, so the row at a shard and slot is computed, too.

Integer arithmetic only, below 2^62, so that any SQL engine gives the same shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triprollup.llm.tables import ceil_div, stored

SHARDS = 16
SEED = 20_260
ROUNDS = 8
#: Fixed values of the round function: a prime modulus and a multiplier.
MODULUS = 2_147_483_647
FACTOR = 48_271
#: A walk step ends with probability 1/2 at least, so 2^-128 of all rows need more.
WALK = 128
#: Rows of a partition while they are numbered.
ROWS = 2_000_000


def _round(half: Column, i: Column, seed: int) -> Column:
    """A fixed pseudo-random number below the modulus for half a place."""
    mixed = (half + i * 7919 + seed) % MODULUS
    squared = (mixed * mixed + FACTOR) % MODULUS
    return (squared * FACTOR + mixed) % MODULUS


def _bits(n: int) -> tuple[int, int]:
    """Sizes of the upper and the lower half for a domain of at least n and under 2n."""
    bits = max(2, (max(n, 1) - 1).bit_length())
    return bits // 2, bits - bits // 2


def _network(x: Column, n: int, seed: int, backwards: bool) -> Column:
    upper, lower = (1 << b for b in _bits(n))
    rounds = range(ROUNDS - 1, -1, -1) if backwards else range(ROUNDS)
    order = F.array(*[F.lit(i).cast("bigint") for i in rounds])

    def turn(x: Column, i: Column) -> Column:
        high, low = F.shiftright(x, lower.bit_length() - 1), x % lower
        into_high = high.bitwiseXOR(_round(low, i, seed) % upper) * lower + low
        into_low = high * lower + low.bitwiseXOR(_round(high, i, seed) % lower)
        return F.when(i % 2 == 0, into_high).otherwise(into_low)

    return F.aggregate(order, x, turn)


def walk(number: Column, n: int, seed: int = SEED, backwards: bool = False) -> Column:
    """The permutation of [0, n), or its inverse. A walk that doesn't end raises an error."""
    x = F.aggregate(
        F.sequence(F.lit(1), F.lit(WALK)),
        _network(number.cast("bigint"), n, seed, backwards),
        lambda x, _: F.when(x < n, x).otherwise(_network(x, n, seed, backwards)),
    )
    return F.when(x < n, x).otherwise(F.raise_error(F.lit("the cycle walk did not end")))


def numbered(rows: DataFrame, order: list[str], total: int) -> DataFrame:
    """Adds `number`, from 0, in the order of the given columns; no task takes all rows.

    Rows are dealt out by ranges of the order and numbered within each range; the sizes
    of the ranges before it are added. Equal rows are told apart by their place in the
    input, so that however many there are, they spread over ranges.
    """
    keys = [*order, "_tie"]
    tied = rows.withColumn("_tie", F.monotonically_increasing_id())
    ranged = tied.repartitionByRange(max(1, ceil_div(total, ROWS), min(total // 10_000, 64)), *keys)
    # The id's upper bits are the partition, its lower 33 the place there.
    local = stored(
        ranged.sortWithinPartitions(*keys)
        .drop("_tie")
        .withColumn("_at", F.monotonically_increasing_id()),
        "numbered",
    )
    part = F.shiftright("_at", 33)
    sizes = local.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    before = sizes.selectExpr(
        "_part",
        "sum(_rows) over (order by _part rows between unbounded preceding and current row)"
        " - _rows as _before",
    )
    # One row for each range: at most a two-millionth of the rows, or 64.
    return (
        local.withColumn("_part", part)
        .join(F.broadcast(before), "_part")
        .withColumn("number", F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1))
        .drop("_part", "_before", "_at")
    )


def number_at(shard: Column, slot: Column, n: int, shards: int = SHARDS, seed: int = SEED) -> Column:
    """The row number at a shard and slot."""
    return walk(slot * shards + shard, n, seed, backwards=True)


def shard_documents(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """doc_id, size, text_crc32, number, shard and slot of each document.

    Rows are numbered by doc_id, then crc32 and size of the text; null ids come first.
    Repeated rows are rows of their own. A null text has size 1 and the crc32 of no bytes.
    Other columns are not read. An empty table gives no rows.
    """
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select(
        "doc_id",
        (F.octet_length(data) + 1).cast("bigint").alias("size"),
        F.crc32(data).alias("text_crc32"),
    )
    total = docs.count()
    at = numbered(rows, ["doc_id", "text_crc32", "size"], total)
    # The walk is computed once: an array of it is opened, not repeated for either column.
    placed = at.withColumn("_at", F.explode(F.array(walk(F.col("number"), total, seed))))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        "number",
        (F.col("_at") % shards).cast("int").alias("shard"),
        F.expr(f"_at div {shards}").alias("slot"),
    )
