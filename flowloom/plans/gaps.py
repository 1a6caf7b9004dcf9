"""Gaps between neighbouring packets of a flow, whatever one flow holds.

A window over a whole flow would put the flow into one task.  Here a flow is
cut into time chunks: the lag runs inside (flow, chunk), and the gap at the
start of a chunk comes from a second lag over one summary row per chunk.  The
gaps are the same for any cut.

A chunk is ten seconds, a length in which one flow, at the speed of a link, sends
no more packets than a task can sort, while a flow that lasts for days has some
ten thousand chunks a day. So one scan is enough. Where links are faster than
that, ``hot_rows`` cuts a flow's chunks of more packets than this further; such
chunks are counted first, in a scan of their own over the key and time columns,
and at most (all packets / ``hot_rows``) of them exist, so their list is small
enough to broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

CHUNK_US = 10_000_000
HOT_ROWS = None
ABSENT = -1


def arrival_order(df: DataFrame) -> list[str]:
    """Columns that order packets: time, then the packet's place in its capture."""
    return ["ts_us"] + [c for c in ("file", "pkt_id", "ip_len") if c in df.columns]


def in_chunks(df: DataFrame, keys: list[str], chunk_us: int = CHUNK_US, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Adds ``chunk``, the start time of the packet's chunk; null keys become ``ABSENT``.

    A key may be null (a frame cut off before its ports), and it still is a
    key: as a plain value it survives the joins on the keys.
    """
    known = df.withColumns({k: F.coalesce(k, F.lit(ABSENT)) for k in keys})
    minute = F.coalesce(F.col("ts_us") - F.pmod("ts_us", F.lit(chunk_us)), F.lit(0))
    if hot_rows is None:
        return known.withColumn("chunk", minute)
    pieces = F.ceil(F.col("n") / hot_rows)
    hot = (
        known.groupBy(*keys, minute.alias("minute")).agg(F.count("*").alias("n"))
        .where(F.col("n") > hot_rows)
        .select(*keys, "minute", F.greatest(F.floor(F.lit(chunk_us) / pieces), F.lit(1)).alias("width"))
    )
    # Subtracting within the minute keeps chunk starts in time order across different widths.
    inside = F.pmod(F.col("ts_us") - F.col("minute"), F.coalesce("width", F.lit(chunk_us)))
    return (
        known.withColumn("minute", minute).join(F.broadcast(hot), [*keys, "minute"], "left")
        .withColumn("chunk", F.coalesce(F.col("ts_us") - inside, F.lit(0))).drop("minute", "width")
    )


def original_keys(keys: list[str]) -> dict[str, Column]:
    """Columns that turn ``ABSENT`` back into null."""
    return {k: F.when(F.col(k) != ABSENT, F.col(k)) for k in keys}


def with_gaps(df: DataFrame, keys: list[str], chunk_us: int = CHUNK_US, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Adds ``gap_us`` (null on a flow's first packet) and ``seq`` (0, 1, … in the flow).

    The packets are shuffled once, on (flow, chunk).  Both the lag and the chunk
    summaries start from that shuffle; only the summaries move again, to the
    flow and back.
    """
    rows = in_chunks(df, keys, chunk_us, hot_rows).repartition(*keys, "chunk")
    # The whole last packet is kept, not just its time, so that this branch
    # reads the same columns and Spark uses one shuffle for both branches.
    rest = [c for c in df.columns if c not in ("ts_us", *keys)]
    summary = rows.groupBy(*keys, "chunk").agg(
        F.max(F.struct("ts_us", *rest)).alias("last"), F.count("*").alias("n"))
    flow = Window.partitionBy(*keys).orderBy("chunk")
    earlier = flow.rowsBetween(Window.unboundedPreceding, -1)
    carry = summary.select(
        *keys, "chunk", F.lag("last.ts_us").over(flow).alias("carry_us"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("carry_n"))
    here = Window.partitionBy(*keys, "chunk").orderBy(*arrival_order(df))
    placed = rows.withColumns({"prev_us": F.lag("ts_us").over(here), "place": F.row_number().over(here)})
    return (
        placed.join(carry.hint("merge"), [*keys, "chunk"])
        .withColumn("gap_us", F.col("ts_us") - F.coalesce("prev_us", "carry_us"))
        .withColumn("seq", F.col("carry_n") + F.col("place") - 1)
        .withColumns(original_keys(keys))
        .drop("chunk", "prev_us", "carry_us", "carry_n", "place")
    )
