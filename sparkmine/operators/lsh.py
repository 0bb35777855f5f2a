"""LSH over MinHash signatures: bands, buckets, candidate pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmine.functions.minhash import band_keys, band_plan, text_signature
from sparkmine.operators.documents import beside_pairs
from sparkmine.operators.skew import pairs_sharing_key, salted_join


def signatures(texts: DataFrame, k: int, n: int = 100) -> DataFrame:
    """Add ``signature`` to ``texts`` with a ``normalized`` column, which goes. Nothing is shuffled."""
    return texts.withColumn("signature", text_signature(F.col("normalized"), k, n)).drop("normalized")


def banded_groups(
    texts: DataFrame, groups: DataFrame, k: int, n: int, threshold: float, crc: bool = False
) -> DataFrame:
    """``group_id, copies, bands``: groups of equal texts with their band keys.

    Signatures are made of one text per group; what is shuffled is a few hundred bytes for each.
    """
    bands, rows = band_plan(n, threshold)
    keys = band_keys(F.col("signature"), bands, rows, crc).alias("bands")
    banded = signatures(texts, k, n).select("group_id", keys)
    return banded.hint("merge").join(groups.select("group_id", "copies").hint("merge"), "group_id").select(
        "group_id", "copies", "bands"
    )


def band_rows(banded: DataFrame) -> DataFrame:
    """``group_id, copies, bands, band, key``, one row per band."""
    return banded.select("*", F.posexplode("bands").alias("band", "key"))


def buckets(rows: DataFrame) -> DataFrame:
    """Buckets that hold more than one document: ``band, key, bucket_id, groups, docs``.

    ``bucket_id`` is the smallest group id in the bucket.
    """
    return (
        rows.groupBy("band", "key")
        .agg(
            F.min("group_id").alias("bucket_id"),
            F.count(F.lit(1)).alias("groups"),
            F.sum("copies").alias("docs"),
        )
        .filter(F.col("docs") > 1)
    )


def bucket_members(rows: DataFrame) -> DataFrame:
    """``band, bucket_id, group_id, groups, docs``: the buckets written out, one row per member."""
    members = rows.select("band", "key", "group_id")
    return salted_join(members, buckets(rows), ["band", "key"]).select(
        "band", "bucket_id", "group_id", "groups", "docs"
    )


def _first_shared_band() -> Column:
    """No band before this one has the same key on both sides."""
    earlier = F.zip_with("x.bands", "y.bands", lambda a, b: a == b)
    return ~F.exists(F.slice(earlier, F.lit(1), F.col("x.band")), lambda same: same)


def candidate_pairs(
    rows: DataFrame,
    block_rows: int | None = None,
    keep: Column | None = None,
    carry: tuple[Column, ...] = (),
) -> DataFrame:
    """Pairs of groups that share a bucket in any band, each once, in the first band that they share.

    ``rows`` is read several times: pass :func:`band_rows` of a durable table.
    """
    once = _first_shared_band()
    return pairs_sharing_key(
        rows,
        ["band", "key"],
        "group_id",
        keep=once if keep is None else keep & once,
        carry=carry,
        block_rows=block_rows,
    )


def sharing_a_band(pairs: DataFrame, banded: DataFrame) -> DataFrame:
    """Those of ``pairs`` that are candidates: some band has the same key on both sides."""
    same = F.exists(F.zip_with("bands1", "bands2", lambda x, y: x == y), lambda eq: eq)
    return beside_pairs(pairs, banded, "bands").filter(same).drop("bands1", "bands2")


def candidate_totals(rows: DataFrame, block_rows: int | None = None) -> DataFrame:
    """``pairs``, to be summed: document pairs of different groups that share a bucket. None is written."""
    both = F.col("x.copies").cast("decimal(18,0)") * F.col("y.copies").cast("decimal(18,0)")
    pairs = candidate_pairs(rows, block_rows, carry=(both.cast("decimal(38,0)").alias("pairs"),))
    return pairs.select("pairs")
