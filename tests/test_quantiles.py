import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from siltworks.operators import quantiles
from siltworks.operators.quantiles import approximate_quantiles, summarize

PROBS = (0.0, 0.1, 0.25, 0.5, 0.75, 1.0)


def frame(spark, values, slices=4):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], "v double").repartition(slices)


def expected(values, p):
    kept = np.sort(np.array([v for v in values if v is not None], dtype=float))
    at = (len(kept) - 1) * p
    low, high = kept[math.floor(at)], kept[math.ceil(at)]
    with np.errstate(invalid="ignore"):
        return low if low == high else (math.ceil(at) - at) * low + (at - math.floor(at)) * high


def same(a, b):
    return a == b or (math.isnan(a) and math.isnan(b))  # halfway between the infinities


RNG = np.random.default_rng(7)
SAMPLES = {
    "normal": RNG.normal(size=3001),
    "cents": np.round(RNG.uniform(-1000, 100000, 4000), 2),
    "third_of_all_rows": np.concatenate([np.full(2000, 0.25), RNG.uniform(0, 1, 4000)]),
    "hot_value_next_to_the_median": np.concatenate([np.full(1500, 1.0), np.nextafter(1.0, 2) + np.zeros(1501)]),
    "many_magnitudes": np.exp(RNG.uniform(-300, 300, 2000)),
    "huge": np.array([-1.7e308, 1.7e308, 5.0, 1e307, -1e300, 0.0, 2.0]),
    "infinite": np.array([-np.inf, -np.inf, 1.0, 2.0, 3.0, np.inf, np.inf, np.inf]),
    "few": np.array([1.0, 2.0, 4.0, 8.0]),
    "one": np.array([42.0]),
    "constant": np.full(500, 0.1),
    "integers": RNG.integers(0, 30, 3000).astype(float),
}


@pytest.mark.parametrize("name", SAMPLES)
@pytest.mark.parametrize("buckets", [16, 256])
def test_histogram_passes_are_exact(spark, name, buckets):
    values = list(SAMPLES[name]) + [None] * 5
    summary = summarize(frame(spark, values), {"v": "v"}, {"v": "v"}, PROBS, buckets)["v"]
    assert summary.n == len(values) - 5
    for p in PROBS:
        assert same(summary.quantiles[p], expected(values, p)), p


@pytest.mark.parametrize("name", SAMPLES)
def test_equal_to_percentile_to_the_last_bit(spark, name):
    df = frame(spark, SAMPLES[name])
    found = summarize(df, {"v": "v"}, probabilities=PROBS)["v"].quantiles
    wanted = df.selectExpr(f"percentile(v, array({', '.join(map(str, PROBS))}))").first()[0]
    assert all(same(found[p], w) for p, w in zip(PROBS, wanted))


def test_fences_of_random_samples_equal_percentile(spark):
    draw = np.random.default_rng(3)
    for _ in range(4):
        df = frame(spark, np.round(draw.lognormal(8, 1, 700), 2))
        found = summarize(df, {"v": "v"})["v"].quantiles
        assert [found[p] for p in (0.25, 0.5, 0.75)] == df.selectExpr("percentile(v, array(0.25, 0.5, 0.75))").first()[0]


@pytest.mark.parametrize("decades", [3, 60, 300])
def test_the_table_is_scanned_twice_for_any_magnitudes(spark, monkeypatch, decades):
    df = spark.range(0, 60_000, 1, 4).selectExpr(f"pow(10D, {decades} * (id / 60000D) - {decades / 2}) * CASE WHEN id % 3 = 0 THEN -1 ELSE 1 END AS v")
    passes, kept = [], []
    narrow, stage = quantiles._narrow, quantiles.stage
    monkeypatch.setattr(quantiles, "_narrow", lambda table, *a: passes.append(table is df) or narrow(table, *a))
    monkeypatch.setattr(quantiles, "stage", lambda *a: kept.append(stage(*a)) or kept[-1])
    found = summarize(df, {"v": "v"})["v"].quantiles
    # the summary, the brackets, and no pass over the table itself
    assert len(passes) <= 7 and not any(passes) and len(kept) == 1
    assert kept[0].filter("s % 2 = 1").count() < 60_000 * 3 * 7 / quantiles.SKETCH
    assert [found[p] for p in (0.25, 0.5, 0.75)] == df.selectExpr("percentile(v, array(0.25, 0.5, 0.75))").first()[0]


def test_ranks_outside_their_brackets_are_found(spark):
    """Infinite values move the ranks of the others away from where the sketch has them."""
    values = [float("-inf")] * 700 + list(np.random.default_rng(1).normal(size=2000)) + [float("inf")] * 100
    found = summarize(frame(spark, values), {"v": "v"}, probabilities=PROBS, buckets=64)["v"].quantiles
    assert all(same(found[p], expected(values, p)) for p in PROBS)


def test_two_hundred_columns(spark):
    columns = {f"c{k}": f"CAST(id * {k + 1} AS DOUBLE)" for k in range(200)}
    found = summarize(spark.range(0, 3001, 1, 3), columns, {"m": "CAST(id AS DOUBLE)"})
    assert all(found[f"c{k}"].quantiles == {0.25: 750.0 * (k + 1), 0.5: 1500.0 * (k + 1), 0.75: 2250.0 * (k + 1)} for k in range(200))


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(allow_nan=False, allow_infinity=True, width=32), min_size=1, max_size=40))
def test_any_values(spark, values):
    summary = summarize(frame(spark, values, 2), {"v": "v"}, probabilities=PROBS, buckets=16)["v"]
    for p in PROBS:
        assert same(summary.quantiles[p], expected(values, p)), p


def test_no_values(spark):
    summary = summarize(frame(spark, [None, None]), {"v": "v"}, {"v": "v"})["v"]
    assert (summary.n, summary.mean, summary.quantiles[0.5]) == (0, None, None)
    assert summarize(frame(spark, []), {"v": "v"})["v"].quantiles[0.5] is None


def test_columns_of_different_sizes_share_the_passes(spark):
    df = spark.range(1000).selectExpr("CAST(id AS DOUBLE) AS a", "CAST(CASE WHEN id < 10 THEN id END AS DOUBLE) AS b")
    both = summarize(df, {"a": "a", "b": "b"})
    assert both["a"].quantiles[0.5] == 499.5 and both["b"].quantiles[0.5] == 4.5


def test_sketch_is_close(spark):
    df = spark.range(10_000).selectExpr("CAST(id AS DOUBLE) AS v")
    found = approximate_quantiles(df, {"v": "v"}, accuracy=1000)["v"].quantiles
    for p, value in found.items():
        assert abs(value - p * 10_000) <= 20


def test_brackets_are_counted_column_by_column(spark, monkeypatch):
    """Rows are not made for all columns at once, whose code is too long to be compiled."""
    plans, stage = [], quantiles.stage
    monkeypatch.setattr(quantiles, "stage", lambda df, name: plans.append(df._jdf.queryExecution().toString()) or stage(df, name))
    df = spark.range(0, 20_000, 1, 2).selectExpr(*[f"CAST(id * {k + 1} % 977 AS DOUBLE) AS c{k}" for k in range(4)])
    names = {c: c for c in df.columns}
    found = summarize(df, names, names)
    assert len(plans) == 1 and "Generate" not in plans[0] and "Union" in plans[0]
    for c in names:
        assert [found[c].quantiles[p] for p in (0.25, 0.5, 0.75)] == df.selectExpr(f"percentile({c}, array(0.25, 0.5, 0.75))").first()[0]
