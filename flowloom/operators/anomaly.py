"""Source-address checks against a registry of networks."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from flowloom.functions.net import subnet
from flowloom.plans.lineage import as_table, fits

BROADCAST_ROWS = 500_000


def _networks(registry: DataFrame) -> DataFrame:
    """One row per network, with the set of AS numbers registered for it."""
    return (
        registry.where("prefix is not null and mask is not null")
        .select(subnet(F.col("prefix"), F.col("mask")).alias("net"),
                        F.col("mask").cast("int").alias("mask"), F.col("asn").cast("int").alias("asn"))
        .groupBy("net", "mask").agg(F.collect_set("asn").alias("asns"))
    )


def spoofs(flows: DataFrame, registry: DataFrame, broadcast_rows: int = BROADCAST_ROWS,
           by: tuple[str, ...] = ()) -> DataFrame:
    """Flows whose source has no registered network, or another AS than its longest one.

    A registry of at most ``broadcast_rows`` networks is joined to the flows by
    broadcast, one equi-join per mask length, so flows are not shuffled.  A
    larger one is matched to the distinct source addresses instead, and only
    the offending (address, AS) pairs meet the flows again.  Both ways give the
    same rows: a flow without source address or AS is no registered one.  ``by``
    columns are carried along.
    """
    networks = as_table(_networks(registry), "networks")  # read once for each mask length
    # At most 33 values: the prefix lengths of IPv4.
    masks = sorted((row.mask for row in networks.select("mask").distinct().collect()), reverse=True)
    if fits(networks, broadcast_rows):
        flagged = _offends_by_broadcast(flows, networks, masks).where("offends").drop("offends")
    else:
        pairs = flows.select("src_addr", "src_as").distinct()
        offending = _offending_pairs(pairs, networks, masks).select(
            F.col("src_addr").alias("bad_addr"), F.col("src_as").alias("bad_as"))
        flagged = flows.join(offending, flows["src_addr"].eqNullSafe(F.col("bad_addr"))
                             & flows["src_as"].eqNullSafe(F.col("bad_as")), "left_semi")
    return flagged.select(*by, "src_addr", "dst_addr", "first_us", "src_as")


def _offends_by_broadcast(flows: DataFrame, networks: DataFrame, masks: list[int]) -> DataFrame:
    rows = flows
    for mask in masks:
        of_mask = networks.where(F.col("mask") == mask).select(
            F.col("net").alias(f"net_{mask}"), F.col("asns").alias(f"asns_{mask}"))
        rows = rows.join(F.broadcast(of_mask),
                         subnet(F.col("src_addr"), mask) == F.col(f"net_{mask}"), "left")
    longest = F.coalesce(*[F.col(f"asns_{m}") for m in masks]) if masks else F.lit(None).cast("array<int>")
    offends = F.coalesce(~F.array_contains(longest, F.col("src_as").cast("int")), F.lit(True))
    return rows.select(*flows.columns, offends.alias("offends"))


def _offending_pairs(pairs: DataFrame, networks: DataFrame, masks: list[int]) -> DataFrame:
    """(address, AS) pairs that offend, by shuffle joins of distinct pairs."""
    lengths = F.array(*[F.lit(m) for m in masks]).cast("array<int>")
    candidates = pairs.withColumn("mask", F.explode_outer(lengths))
    candidates = candidates.withColumn("net", subnet(F.col("src_addr"), F.col("mask")))
    best = (
        candidates.join(networks, ["net", "mask"], "left")
        .groupBy("src_addr", "src_as")
        .agg(F.max_by("asns", F.when(F.col("asns").isNotNull(), F.col("mask"))).alias("asns"))
    )
    known = F.array_contains("asns", F.col("src_as").cast("int"))
    return best.where(~F.coalesce(known, F.lit(False))).select("src_addr", "src_as")
