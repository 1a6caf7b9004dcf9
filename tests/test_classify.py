"""Classifiers against a plain Python computation; fits against planted parameters."""

import math
import random

import pytest

from flowloom.operators import classify
from tests.conftest import packet_rows
from tests.test_packets import CUTS, brute_gaps, p, random_packets


def pdf(x, mean, sd):
    return math.exp(-((x - mean) ** 2) / (2 * sd * sd)) / (sd * math.sqrt(2 * math.pi))


def mixture_score(components, size, gap):
    density = sum(w * pdf(size, *s) * pdf(gap, *g) for w, s, g in components)
    return math.log(density) if density > 0 else 0.0


def normal_score(parameters, size, gap):
    def term(x, parameters):
        density = pdf(x, *parameters)
        return 0 if x <= 0 else math.log(density) if density > 0 else -math.inf
    return term(size, parameters[0]) + term(gap, parameters[1])


def labels(rows, http, smtp):
    out = {}
    for key, v in brute_gaps(rows).items():
        pairs = [(b[2], (b[0] - a[0]) / 1e6) for a, b in zip(v, v[1:])]
        h, s = (sum(f(size, gap) for size, gap in pairs) for f in (http, smtp))
        out[key] = ("HTTP" if h > s else "SMTP", len(v))
    return out


@pytest.mark.parametrize("chunk_us, hot_rows", CUTS)
def test_labels_equal_brute_force_for_any_cut(spark, chunk_us, hot_rows):
    rows = random_packets(400, 21)
    df = packet_rows(spark, rows)
    got = {r.src_port: (r.label, r.packets) for r in classify.classify_gmm(df, chunk_us, hot_rows).collect()}
    assert got == labels(rows, lambda *x: mixture_score(classify.HTTP_MIXTURE, *x),
                         lambda *x: mixture_score(classify.SMTP_MIXTURE, *x))
    got = {r.src_port: (r.label, r.packets) for r in classify.classify_normal(df, chunk_us, hot_rows).collect()}
    assert got == labels(rows, lambda *x: normal_score(classify.HTTP_NORMAL, *x),
                         lambda *x: normal_score(classify.SMTP_NORMAL, *x))


def test_single_packets_ties_and_excluded_packets(spark):
    rows = [p(1, 0, sport=1), p(2, 0, sport=2, payload_len=0), p(3, 0, sport=3, proto=17), p(4, 0, sport=4, eth=0x86DD)]
    got = [(r.src_port, r.label) for r in classify.classify_gmm(packet_rows(spark, rows)).collect()]
    assert got == [(1, "SMTP")]


def test_zero_density_adds_nothing(spark):
    # After years of silence both densities underflow to zero, so the sums tie.
    rows = [p(1, 0, ip_len=424), p(2, 10**15, ip_len=424)]
    assert classify.classify_gmm(packet_rows(spark, rows)).first().label == "SMTP"


def test_microseconds_are_not_decimal_digits(spark):
    # 5 µs and 40 µs after a full second are 35 µs apart, whatever their digits look like.
    rows = packet_rows(spark, [p(1, 1_000_005, ip_len=100), p(2, 1_000_040, ip_len=100)])
    training = classify.training_rows(rows).first()
    assert training.gap_s == pytest.approx(35e-6)


def test_success_ratio(spark):
    classified = spark.createDataFrame(
        [(1, 80, "HTTP"), (2, 80, "HTTP"), (3, 80, "SMTP"), (25, 9, "SMTP"), (7, 8, "HTTP")],
        "src_port int, dst_port int, label string")
    got = {(r.truth, r.predicted): (r.flows, round(r.ratio, 6)) for r in classify.success_ratio(classified).collect()}
    assert got == {("HTTP", "HTTP"): (2, 0.666667), ("HTTP", "SMTP"): (1, 0.333333), ("SMTP", "SMTP"): (1, 1.0)}


def test_logit_finds_planted_coefficients(spark):
    rng = random.Random(1)
    rows = []
    for _ in range(6000):
        size, gap = float(rng.randrange(40, 1500)), rng.random() * 10
        chance = 1 / (1 + math.exp(-(2.0 - 0.005 * size + 0.2 * gap)))
        rows.append(("SMTP" if rng.random() < chance else "HTTP", size, gap))
    fitted = classify.fit_logit(spark.createDataFrame(rows, "label string, size double, gap_s double"))
    got = {r.term: r for r in fitted.collect()}
    assert got["size"].estimate == pytest.approx(-0.005, abs=0.0006)
    assert got["gap_s"].estimate == pytest.approx(0.2, abs=0.05)
    assert got["(Intercept)"].estimate == pytest.approx(2.0, abs=0.3)
    assert got["size"].p_value < 1e-6 and got["size"].std_error > 0


def test_mixture_finds_planted_components(spark):
    rng = random.Random(2)
    rows = [("HTTP", rng.gauss(400, 30), rng.gauss(1, 0.2)) for _ in range(1200)]
    rows += [("HTTP", rng.gauss(1200, 50), rng.gauss(6, 0.5)) for _ in range(800)]
    fitted = classify.fit_gmm(spark.createDataFrame(rows, "label string, size double, gap_s double"))
    low, high = sorted(fitted.collect(), key=lambda r: r.size_mean)
    assert low.size_mean == pytest.approx(400, abs=10) and high.size_mean == pytest.approx(1200, abs=15)
    assert low.weight == pytest.approx(0.6, abs=0.03) and high.gap_mean == pytest.approx(6, abs=0.2)
    assert low.size_sd == pytest.approx(30, abs=5)


def test_fit_normal_has_both_deviations(spark):
    rows = spark.createDataFrame([("HTTP", 1.0, 2.0), ("HTTP", 3.0, 2.0)], "label string, size double, gap_s double")
    row = classify.fit_normal(rows).first()
    assert (row.size_mean, row.size_sd_mle) == (2.0, 1.0)
    assert row.size_sd == pytest.approx(math.sqrt(2)) and row.gap_s_sd == 0
