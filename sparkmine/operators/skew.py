"""Joins that stay even when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmine.operators.storage import broadcast_if_small, durable, small, stored_bytes

BLOCK_ROWS = 2_000
SALT_ROWS = 1_000_000
ARRAY_ROWS = 10_000  # salt for rows that carry an array of some kilobytes
TOP_SHARE = 100_000  # keys with more than one in so many rows are at most so many keys


def heavy_keys(rows: DataFrame, keys: Sequence[str], over: int) -> DataFrame:
    """The keys with more than ``over`` rows, and how many, written once so that all readers agree."""
    counted = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("key_rows"))
    return durable(counted.filter(F.col("key_rows") > over), "heavy")


def with_parts(rows: DataFrame, keys: Sequence[str], heavy: DataFrame, over: int) -> DataFrame:
    """Add ``parts``: into how many parts of about ``over`` rows a row's key is cut, 1 for a light key.

    Two tiers. Keys above ``1 / TOP_SHARE`` of all heavy rows are at most ``TOP_SHARE`` by arithmetic, so
    that list is broadcast. The other heavy keys may be many, but none has more than that share of the
    rows, so an ordinary join with their counts stays even.
    """
    keys = list(keys)
    one = F.coalesce("parts", F.lit(1)).alias("parts")
    total, least = heavy.agg(F.sum("key_rows"), F.min("key_rows")).first()
    if least is None:
        return rows.withColumn("parts", F.lit(1))
    parts = F.ceil(F.col("key_rows") / F.lit(over)).cast("int")
    listed = heavy.select(*keys, "key_rows", parts.alias("parts"))
    top = listed.filter(F.col("key_rows") > F.lit(total / TOP_SHARE)).drop("key_rows")
    rest = listed.filter(F.col("key_rows") <= F.lit(total / TOP_SHARE)).drop("key_rows")
    if least > total / TOP_SHARE:
        return rows.join(F.broadcast(top), keys, "left").select(*rows.columns, one)
    first = rows.join(F.broadcast(top), keys).select(*rows.columns, "parts")
    others = rows.join(F.broadcast(top.drop("parts")), keys, "left_anti")
    return first.unionByName(others.join(rest, keys, "left").select(*rows.columns, one))


def light(rows: DataFrame, over: int) -> bool:
    """Whether the files behind ``rows`` have fewer than ``over`` bytes, so that no key is worth a count."""
    return bool(rows.inputFiles()) and stored_bytes(rows) < over


def salted_join(
    many: DataFrame,
    few: DataFrame,
    keys: Sequence[str],
    over: int | None = None,
    heavy: DataFrame | None = None,
) -> DataFrame:
    """Inner equi-join in which ``few`` has at most a handful of rows per key.

    Rows of a heavy key in ``many`` are dealt over several salts and the matching rows of ``few`` are
    repeated once per salt, so no task receives a whole heavy key. ``heavy`` may come from a table
    that is cheaper to count than ``many``. ``over`` is the rows that a key may have unsplit; rows that
    carry arrays want a smaller number.
    """
    over = SALT_ROWS if over is None else over
    if heavy is None and light(many, over):
        return many.join(few, list(keys))
    if heavy is None:
        heavy = heavy_keys(many, keys, over)
    if heavy.isEmpty():
        return many.join(few, list(keys))
    deal = F.pmod(F.xxhash64(*[F.col(c) for c in many.columns]), F.col("parts")).cast("int")
    left = with_parts(many, keys, heavy, over).withColumn("salt", deal).drop("parts")
    right = (
        with_parts(few, keys, heavy, over)
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .drop("parts")
    )
    return left.join(right, [*keys, "salt"]).drop("salt")


def lookup_join(
    many: DataFrame, few: DataFrame, keys: Sequence[str], over: int | None = None, fits: bool | None = None
) -> DataFrame:
    """Inner join with a durable table: broadcast if its bytes are few, salted if not.

    ``fits`` is the answer to that question if it is known.
    """
    if small(few) if fits is None else fits:
        return many.join(F.broadcast(few), list(keys))
    return salted_join(many, few, keys, over)


def lookup_semi(many: DataFrame, few: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of ``many`` whose key is in the durable table ``few``, each once."""
    return many.join(broadcast_if_small(few), list(keys), "left_semi")


def pairs_sharing_key(
    rows: DataFrame,
    keys: Sequence[str],
    id_col: str,
    keep: Column | None = None,
    carry: Sequence[Column] = (),
    block_rows: int | None = None,
    heavy: DataFrame | None = None,
) -> DataFrame:
    """Every unordered pair of distinct ids that share ``keys``, once per shared key.

    A heavy key is cut into blocks of about ``block_rows`` rows and joined block against block, so
    its work spreads over many tasks. ``keep`` is a condition over columns of the two sides, named
    ``x.*`` and ``y.*``, applied inside the join so that failing pairs never become rows; ``carry``
    are further columns to return, made from the same two sides.
    ``heavy`` may be given if the keys above ``block_rows`` are known; otherwise rows whose key no other row has
    are left out before the join. ``rows`` is read three times: pass a durable table.
    """
    block_rows = BLOCK_ROWS if block_rows is None else block_rows
    if heavy is None:
        common = heavy_keys(rows, keys, 1)
        heavy = common.filter(F.col("key_rows") > block_rows)
        rows = lookup_semi(rows, common.select(*keys), keys)
    blocked = with_parts(rows, keys, heavy, block_rows).withColumn(
        "block", F.pmod(F.xxhash64(id_col), F.col("parts")).cast("int")
    )
    x = (
        blocked.withColumn("block_y", F.explode(F.sequence(F.col("block"), F.col("parts") - 1)))
        .withColumnRenamed("block", "block_x")
        .alias("x")
    )
    y = (
        blocked.withColumn("block_x", F.explode(F.sequence(F.lit(0), F.col("block"))))
        .withColumnRenamed("block", "block_y")
        .alias("y")
    )
    on = [F.col(f"x.{c}") == F.col(f"y.{c}") for c in [*keys, "block_x", "block_y"]]
    first, second = F.col(f"x.{id_col}"), F.col(f"y.{id_col}")
    on.append(F.when(F.col("x.block_x") == F.col("x.block_y"), first < second).otherwise(first != second))
    if keep is not None:
        on.append(keep)
    return x.join(y, on).select(
        F.least(first, second).alias("id1"), F.greatest(first, second).alias("id2"), *carry
    )
