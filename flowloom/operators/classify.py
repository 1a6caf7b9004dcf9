"""HTTP/SMTP classification of TCP flows, and the fits behind it."""

from __future__ import annotations

import math
from functools import reduce
from operator import add

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from flowloom.functions.density import log_if_positive, mixture_pdf, normal_pdf
from flowloom.functions.net import FIVE_TUPLE, TCP
from flowloom.operators.packets import ipv4
from flowloom.plans.gaps import CHUNK_US, HOT_ROWS, arrival_order, in_chunks, original_keys, with_gaps
from flowloom.plans.lineage import cut

# Mixture weights and (size mean, sd), (gap mean, sd) of both classes.
HTTP_MIXTURE = [
    (0.6, (424.217, 162.760), (2.592, 57.180)),
    (0.4, (1205.283, 204.101), (2.566, 56.458)),
]
SMTP_MIXTURE = [
    (0.6, (821.138, 173.548), (0.612, 4.032)),
    (0.4, (101.601, 53.341), (2.792, 22.558)),
]

# Single-normal (size mean, sd), (gap mean, sd) of both classes.
HTTP_NORMAL = ((628.7194, 385.1892), (2.584803, 56.99175))
SMTP_NORMAL = ((222.4691, 282.4612), (2.425682, 20.6584))

# Well-known ports that name the true class of a flow.
PORT_CLASS = {80: "HTTP", 25: "SMTP"}


def data_packets(packets: DataFrame) -> DataFrame:
    """IPv4 TCP packets with a non-empty payload, with the columns the classifiers read."""
    rows = ipv4(packets).where((F.col("proto") == TCP) & (F.col("payload_len") != 0))
    order = [c for c in arrival_order(packets) if c not in ("ts_us", "ip_len")]
    return rows.select(*FIVE_TUPLE, "ts_us", "ip_len", *order)


def _mixture_score(components):
    def score(size: Column, gap: Column) -> Column:
        density = mixture_pdf(size, gap, components)
        return log_if_positive(density, density)
    return score


def _normal_score(parameters):
    (size_mean, size_sd), (gap_mean, gap_sd) = parameters

    def score(size: Column, gap: Column) -> Column:
        return (log_if_positive(size, normal_pdf(size, size_mean, size_sd))
                + log_if_positive(gap, normal_pdf(gap, gap_mean, gap_sd)))
    return score


def _classify(packets: DataFrame, http, smtp, chunk_us: int, hot_rows: int | None) -> DataFrame:
    """Sums both scores over the packets after a flow's first, and labels the flow.

    Two shuffles: packets on (flow, chunk), then one row per chunk on the flow.
    A chunk's row carries its inner sums, plus what its first packet needs to be
    scored against the end of the chunk before.
    """
    seconds = F.lit(1e6)
    gap = (F.col("ts_us") - F.col("prev_us")) / seconds
    size = F.col("ip_len").cast("double")
    rows = data_packets(packets)
    here = Window.partitionBy(*FIVE_TUPLE, "chunk").orderBy(*arrival_order(rows))
    chunks = (
        in_chunks(rows, FIVE_TUPLE, chunk_us, hot_rows)
        .withColumn("prev_us", F.lag("ts_us").over(here))
        .withColumn("http", F.when(F.col("prev_us").isNotNull(), http(size, gap)))
        .withColumn("smtp", F.when(F.col("prev_us").isNotNull(), smtp(size, gap)))
        .groupBy(*FIVE_TUPLE, "chunk")
        .agg(F.count("*").alias("n"), F.min("ts_us").alias("first_us"), F.max("ts_us").alias("last_us"),
             F.max(F.when(F.col("prev_us").isNull(), F.col("ip_len"))).cast("double").alias("first_len"),
             F.coalesce(F.sum("http"), F.lit(0.0)).alias("http"),
             F.coalesce(F.sum("smtp"), F.lit(0.0)).alias("smtp"))
    )
    before = Window.partitionBy(*FIVE_TUPLE).orderBy("chunk")
    seam = (F.col("first_us") - F.col("carry_us")) / seconds
    first_len = F.col("first_len")
    has_seam = F.col("carry_us").isNotNull()
    return (
        chunks.withColumn("carry_us", F.lag("last_us").over(before))
        .withColumn("http", F.col("http") + F.when(has_seam, http(first_len, seam)).otherwise(0.0))
        .withColumn("smtp", F.col("smtp") + F.when(has_seam, smtp(first_len, seam)).otherwise(0.0))
        .groupBy(*FIVE_TUPLE)
        .agg(F.sum("n").alias("packets"), F.sum("http").alias("http"), F.sum("smtp").alias("smtp"))
        .select(*[c.alias(k) for k, c in original_keys(FIVE_TUPLE).items()], "packets",
                F.when(F.col("http") > F.col("smtp"), "HTTP").otherwise("SMTP").alias("label"))
    )


def classify_gmm(packets: DataFrame, chunk_us: int = CHUNK_US, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Label per flow from two-component normal mixtures over (size, gap)."""
    return _classify(packets, _mixture_score(HTTP_MIXTURE), _mixture_score(SMTP_MIXTURE), chunk_us, hot_rows)


def classify_normal(packets: DataFrame, chunk_us: int = CHUNK_US, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Label per flow from one normal for size and one for gap."""
    return _classify(packets, _normal_score(HTTP_NORMAL), _normal_score(SMTP_NORMAL), chunk_us, hot_rows)


def true_class() -> Column:
    """Class named by a well-known port on either side, else null."""
    truth = F
    for port, name in PORT_CLASS.items():
        truth = truth.when((F.col("dst_port") == port) | (F.col("src_port") == port), name)
    return truth


def success_ratio(classified: DataFrame) -> DataFrame:
    """Flows per true and predicted class, and the share of that true class."""
    counts = (
        classified.withColumn("truth", true_class()).where(F.col("truth").isNotNull())
        .groupBy("truth", F.col("label").alias("predicted")).agg(F.count("*").alias("flows"))
    )
    of_truth = Window.partitionBy("truth")
    return counts.withColumn("ratio", F.col("flows") / F.sum("flows").over(of_truth))


def training_rows(packets: DataFrame, chunk_us: int = CHUNK_US, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """(label, size, gap_s) of every packet that has a packet before it in a labelled flow."""
    rows = data_packets(packets).withColumn("label", true_class()).where(F.col("label").isNotNull())
    return (
        with_gaps(rows, FIVE_TUPLE, chunk_us, hot_rows).where(F.col("gap_us").isNotNull())
        .select("label", F.col("ip_len").cast("double").alias("size"),
                (F.col("gap_us") / F.lit(1e6)).alias("gap_s"))
    )


def fit_normal(training: DataFrame) -> DataFrame:
    """Mean, sample deviation and maximum-likelihood deviation of size and gap, per class."""
    return training.groupBy("label").agg(
        F.count("*").alias("n"),
        *[f(c).alias(f"{c}_{name}") for c in ("size", "gap_s") for name, f in
          (("mean", F.avg), ("sd", F.stddev_samp), ("sd_mle", F.stddev_pop))])


def _weighted(training: DataFrame) -> DataFrame:
    """Equal rows as one with a weight, written once: the fits read their input many times."""
    return cut(training.where(F.col("size").isNotNull() & F.col("gap_s").isNotNull()).groupBy("label", "size", "gap_s").agg(
        F.count("*").cast("double").alias("weight")))


LOGIT_TERMS = ("(Intercept)", "size", "gap_s")
LOGIT_STEPS = 25
LOGIT_TOLERANCE = 1e-12


def fit_logit(training: DataFrame, positive: str = "SMTP", steps: int = LOGIT_STEPS) -> DataFrame:
    """Binomial logit of the class on size and gap: estimate, standard error, p-value per term.

    Reweighted least squares by normal equations: a step is one aggregation of nine
    sums over all rows, and a 3 x 3 system on the driver. It stops when no estimate
    moves any more; the standard errors come from the inverse of the last matrix. If a
    system has no solution (classes that a line parts, a term that never varies), what was
    reached is given, with null errors. Without rows, or with one class, the table is empty.
    """
    spark = training.sparkSession
    schema = "term string, estimate double, std_error double, p_value double"
    rows = _weighted(training).withColumn("target", F.when(F.col("label") == positive, 1.0).otherwise(0.0))
    if rows.select("target").distinct().count() < 2:
        return spark.createDataFrame([], schema)
    x = [F.lit(1.0), F.col("size"), F.col("gap_s")]
    beta, inverse = np.zeros(3), None
    for _ in range(steps):
        eta = reduce(add, [F.lit(float(b)) * c for b, c in zip(beta, x)])
        mu = 1 / (1 + F.exp(-eta))
        spread = F.col("weight") * mu * (1 - mu)
        sums = rows.agg(
            *[F.sum(spread * x[i] * x[j]).alias(f"a{i}{j}") for i in range(3) for j in range(i, 3)],
            *[F.sum(F.col("weight") * (F.col("target") - mu) * x[i]).alias(f"g{i}") for i in range(3)]).first()
        matrix = np.array([[sums[f"a{min(i, j)}{max(i, j)}"] for j in range(3)] for i in range(3)])
        try:
            inverse = np.linalg.inv(matrix)
        except np.linalg.LinAlgError:
            inverse = None
            break
        move = inverse @ np.array([sums[f"g{i}"] for i in range(3)])
        if not np.isfinite(move).all():
            inverse = None
            break
        beta = beta + move
        if (abs(move) <= LOGIT_TOLERANCE * (1 + abs(beta))).all():
            break
    table = []
    for i, term in enumerate(LOGIT_TERMS):
        error = float(inverse[i, i]) ** 0.5 if inverse is not None and inverse[i, i] > 0 else None
        p = math.erfc(abs(beta[i] / error) / math.sqrt(2)) if error else None
        table.append((term, float(beta[i]), error, p))
    return spark.createDataFrame(table, schema)


GMM_STEPS = 30
LEAST_VARIANCE = 1e-6


def fit_gmm(training: DataFrame, k: int = 2, steps: int = GMM_STEPS) -> DataFrame:
    """Mixture of ``k`` normals with diagonal covariance per class: weight, means and standard deviations.

    Expectation and maximisation as one weighted aggregation a step over all rows and
    classes; the driver holds the parameters alone. A row's densities are added by
    log-sum-exp, variances are taken around the means before and never fall below
    ``LEAST_VARIANCE`` of the class's own. The components start with the class's mean gap
    and deviations, their mean sizes spread evenly over two deviations; ``steps`` is the
    number of steps, so the result depends on nothing else.
    """
    spark = training.sparkSession
    rows = _weighted(training)
    w = F.col("weight")

    def mean_of(c):
        return F.sum(w * F.col(c)) / F.sum(w)
    means = rows.groupBy("label").agg(F.sum(w).alias("n"), *[mean_of(c).alias(f"{c}_mean") for c in ("size", "gap_s")])
    whole = rows.join(F.broadcast(means), "label").groupBy("label").agg(
        F.first("n").alias("n"), *[F.first(f"{c}_mean").alias(f"{c}_mean") for c in ("size", "gap_s")],
        *[(F.sum(w * F.pow(F.col(c) - F.col(f"{c}_mean"), 2)) / F.first("n")).alias(f"{c}_var") for c in ("size", "gap_s")])
    state, least = {}, {}
    for row in whole.collect():  # one row per class
        spread = [2 * i / (k - 1) - 1 if k > 1 else 0.0 for i in range(k)]
        least[row.label] = [max(v * LEAST_VARIANCE, 1e-300) for v in (row.size_var, row.gap_s_var)]
        varies = [max(v, low) for v, low in zip((row.size_var, row.gap_s_var), least[row.label])]
        state[row.label] = [(1 / k, row.size_mean + s * math.sqrt(varies[0]), varies[0], row.gap_s_mean, varies[1]) for s in spread]
    for _ in range(steps if state else 0):
        now = spark.createDataFrame(
            [(label, [list(map(float, c)) for c in of]) for label, of in state.items()], "label string, c array<array<double>>")

        def log_density(i):
            share, m1, v1, m2, v2 = (F.get(F.get("c", F.lit(i)), F.lit(j)) for j in range(5))
            return (F.ln(share) - (F.ln(v1) + F.ln(v2)) / 2 - F.pow(F.col("size") - m1, 2) / (2 * v1)
                    - F.pow(F.col("gap_s") - m2, 2) / (2 * v2))
        scored = rows.join(F.broadcast(now), "label").withColumn("logs", F.array(*[log_density(i) for i in range(k)]))
        top = F.array_max("logs")
        scored = scored.withColumn("shares", F.transform("logs", lambda v: F.exp(v - top)))
        scored = scored.withColumn("all", F.aggregate("shares", F.lit(0.0), lambda a, b: a + b))
        parts = []
        for i in range(k):
            r = w * F.get("shares", F.lit(i)) / F.col("all")
            away = [F.col(c) - F.get(F.get("c", F.lit(i)), F.lit(at)) for c, at in (("size", 1), ("gap_s", 3))]
            parts += [F.sum(r).alias(f"n{i}"), *[F.sum(r * d).alias(f"d{i}{j}") for j, d in enumerate(away)],
                      *[F.sum(r * d * d).alias(f"q{i}{j}") for j, d in enumerate(away)]]
        for row in scored.groupBy("label").agg(F.sum(w).alias("n"), *parts).collect():
            of = []
            for i, (_, m1, v1, m2, v2) in enumerate(state[row.label]):
                n = row[f"n{i}"]
                if n <= 0:  # no row is left to it
                    of.append((1e-300, m1, v1, m2, v2))
                    continue
                move = [row[f"d{i}{j}"] / n for j in range(2)]
                varies = [max(row[f"q{i}{j}"] / n - move[j] ** 2, least[row.label][j]) for j in range(2)]
                of.append((n / row.n, m1 + move[0], varies[0], m2 + move[1], varies[1]))
            state[row.label] = of
    table = [(label, float(p), float(m1), math.sqrt(v1), float(m2), math.sqrt(v2))
             for label, of in sorted(state.items()) for p, m1, v1, m2, v2 in of]
    return spark.createDataFrame(
        table, "label string, weight double, size_mean double, size_sd double, gap_mean double, gap_sd double")
