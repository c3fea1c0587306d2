"""Guards against hot keys, against broadcasting what may grow, and against shuffling what can match nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows of one key that a task can take; a key with more is cut into slices of about that many.
SLICE_ROWS = 2_000_000
# Hot keys are broadcast up to this number (a few hundred bytes each), and joined by a shuffle beyond it.
BROADCAST_KEYS = 50_000
# A Bloom filter has so many bits a key, and goes to every executor as at most so many words of 64 bits (some 40 bytes each).
BITS_A_KEY = 16
BROADCAST_WORDS = 1 << 21


def hot_keys(sizes: DataFrame, keys: list[str], rows: str = "n", slice_rows: int = SLICE_ROWS) -> DataFrame | None:
    """The hot keys with the number of `slices` for each; None if no key is hot.

    `sizes` has one row per key with its number of rows. A small job counts the hot ones, whose number
    decides how they are joined; give it a stored table.
    """
    hot = sizes.where(F.col(rows) > slice_rows)
    if not hot.take(1):
        return None
    slices = F.ceil(F.col(rows) / F.lit(slice_rows)).cast("int")
    return broadcast_within(hot.select(*keys, slices.alias("slices")), BROADCAST_KEYS)


def salt_rows(rows: DataFrame, hot: DataFrame, keys: list[str], salt: str = "salt") -> DataFrame:
    """Gives each row of a hot key one of its slices, and 0 to all others.

    `hot` comes from `hot_keys`, which has checked its size for a broadcast. The slice follows from the row's content and the partition it is in. Copies of one row, which a digest
    alone would keep together, spread with the partitions; and a task that runs again after a lost executor
    deals its rows the same way, in whatever order it meets them, which a running number would not.
    """
    content = F.xxhash64(*(c for c in rows.columns if c not in keys))
    step = F.spark_partition_id().cast("bigint") * F.lit(7919)
    return (
        rows.withColumn("_deal", F.pmod(content, F.lit(1 << 40)) + step)
        .join(hot, keys, "left")
        .withColumn(salt, F.coalesce(F.pmod("_deal", "slices"), F.lit(0)).cast("int"))
        .drop("_deal", "slices")
    )


def repeat_for_salts(rows: DataFrame, hot: DataFrame, keys: list[str], salt: str = "salt") -> DataFrame:
    """The other side of the join: each row of a hot key once per slice."""
    slices = F.coalesce(F.col("slices"), F.lit(1))
    return (
        rows.join(hot, keys, "left")
        .withColumn(salt, F.explode(F.sequence(F.lit(0), slices - 1)))
        .drop("slices")
    )


def broadcast_within(side: DataFrame, max_rows: int) -> DataFrame:
    """A broadcast hint if `side` has at most `max_rows` rows (a small job finds out), else `side` as it is,
    for a shuffled join."""
    return F.broadcast(side) if side.limit(max_rows + 1).count() <= max_rows else side


def key_bits(members: DataFrame, keys: list[str], max_words: int = BROADCAST_WORDS) -> tuple[DataFrame, int] | None:
    """A Bloom filter of one hash: rows (`_word`, `_bits`) for the words with a bit set, and the number of all words.

    None where there are too many members for the bound on words. A small job counts the members; give it a
    stored table.
    """
    wanted = members.count() * BITS_A_KEY // 64 + 1
    words = 1 << (wanted - 1).bit_length()
    if words > max_words:
        return None
    place = F.xxhash64(*keys)
    placed = members.select(F.pmod(place, F.lit(words)).alias("_word"), _bit(place).alias("_bit"))
    return placed.groupBy("_word").agg(F.expr("bit_or(shiftleft(1L, _bit))").alias("_bits")), words


def _bit(place: F.Column) -> F.Column:
    """The bit in its word, from other digits of the hash than those that name the word."""
    return F.shiftrightunsigned(place, 58).cast("int")


def possible_members(rows: DataFrame, members: DataFrame, keys: list[str], max_words: int = BROADCAST_WORDS) -> DataFrame:
    """`rows` without most of those whose keys no member has, told where the rows are read and without a shuffle.

    Every row with a member stays, and about one in `BITS_A_KEY` of the others, so it goes before an inner join
    and not in its place. Rows with a NULL in a key are treated like all others. Beyond the bound on the
    filter's size all rows stay.
    """
    found = key_bits(members, keys, max_words)
    if found is None:
        return rows
    bits, words = found
    place = F.xxhash64(*keys)
    return (
        rows.withColumn("_word", F.pmod(place, F.lit(words)))
        .join(F.broadcast(bits), "_word")
        .where(F.getbit("_bits", _bit(place)) == 1)
        .select(*rows.columns)
    )
