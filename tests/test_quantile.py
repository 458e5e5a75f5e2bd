import math
import random

import pytest

from gristmill.operators import curate, quantile, report


def plain(values, fraction):
    v = sorted(values)
    at = (len(v) - 1) * fraction
    a, b, part = v[math.floor(at)], v[math.ceil(at)], at - math.floor(at)
    return a if a == b else (1 - part) * a + part * b


@pytest.mark.parametrize("finish,ranges", [(0, 1000), (5, 7), (10_000, 1000)])
def test_percentiles_equal_sorted_lists(spark, monkeypatch, finish, ranges):
    monkeypatch.setattr(quantile, "FINISH", finish)
    monkeypatch.setattr(quantile, "RANGES", ranges)
    rng = random.Random(7)
    groups = {
        "even": [rng.uniform(-5, 5) for _ in range(300)], "ties": [float(rng.randrange(3)) for _ in range(300)], "two": [1.0] * 50 + [9.0] * 50, "one": [4.0],
        "same": [2.5] * 80, "wide": [10.0 ** rng.randrange(-8, 9) for _ in range(60)], None: [3.0, 1.0, 2.0], "ends": [-1.7e308, 1.7e308, 0.0, 1.0], "infinite": [1.0, 2.0, math.inf],
    }
    rows = [(g, v, 1) for g, vs in groups.items() for v in vs] + [("even", None, 1), ("none", None, 1), ("none", math.nan, 1)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, v double, _n int")
    for fraction in (0.1, 1.0) if finish else (0.37,):
        got = {r.g: r.percentile for r in quantile.percentiles(df, ["g"], "v", fraction).collect()}
        assert got == {g: pytest.approx(plain(vs, fraction), rel=1e-12) for g, vs in groups.items()}


def test_reports_use_them(spark):
    df = spark.createDataFrame([("a", n) for n in range(10, 101, 10)] + [("b", 7)], "g string, n long")
    assert {r.g: r.cutoff for r in curate.cutoffs(df, "g", "n", 0.1, ["a", "b"]).collect()} == {"a": 19, "b": 7}
    assert report.numbers(df.where("g = 'a'"), "n").first().median == 55.0
    assert tuple(report.numbers(df.where("g = 'c'"), "n").first()) == (None, None, 0.0, None, None)
    assert quantile.percentiles(df, [], "n", 0.5).first()[0] == 50.0
