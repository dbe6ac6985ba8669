import random

import struct

import numpy as np
import pytest

from linesmith.operators import quantiles
from linesmith.operators.quantiles import double_of, exact_quantiles, images


def frame(spark, columns):
    n = max(map(len, columns.values()))
    data = [tuple(v[i] if i < len(v) else None for v in columns.values()) for i in range(n)]
    return spark.createDataFrame(data, ", ".join(f"{c} double" for c in columns)).repartition(5)


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("q", [0.0, 0.25, 0.5, 0.9, 1.0])
def test_equals_numpy_through_many_rounds(spark, seed, q):
    rnd = random.Random(seed)
    columns = {
        "even": [rnd.gauss(0, 1) for _ in range(1000)],
        "odd": [rnd.gauss(5, 9) for _ in range(777)],
        "ties": [float(rnd.choice([1, 1, 1, 2, 2, 3])) for _ in range(900)],
        "two": [1.0] * 500 + [2.0] * 500,
        "one": [4.5], "none": [],
    }
    got = exact_quantiles(frame(spark, columns), list(columns), q, bits=3)
    for name, values in columns.items():
        if not values:
            assert got[name] is None
        else:
            assert got[name] == pytest.approx(np.quantile(values, q), rel=1e-12), name


def test_defaults(spark):
    values = [float(i % 97) ** 2 for i in range(5000)]
    got = exact_quantiles(frame(spark, {"v": values}), ["v"])
    assert got["v"] == np.median(values)


def test_ends_on_infinities_nan_and_the_whole_range(spark):
    inf, nan, big = float("inf"), float("nan"), 1.7976931348623157e308
    columns = {"some": [inf, -inf, nan, 1.0, 2.0, 5e-324, 0.0], "all": [inf, inf], "wide": [-big, big, 1.0], "close": [5e-324, 0.0, 1e-323]}
    got = exact_quantiles(frame(spark, columns), list(columns), 0.5, bits=2)
    assert got == {"some": (1.0 + 5e-324) / 2, "all": inf, "wide": 1.0, "close": 5e-324}
    many = {"v": [float(i) for i in range(300)] + [inf]}
    assert exact_quantiles(frame(spark, many), ["v"])["v"] == 150.0


def test_images_are_the_bits_of_doubles(spark):
    rnd = random.Random(1)
    values = [0.0, -0.0, 5e-324, -5e-324, 2.0 ** -1022, 2.0 ** -1022 - 5e-324, 1.7976931348623157e308, float("inf"), -float("inf")]
    values += [sign * 2.0 ** e * f for e in range(-1074, 1023) for f in (1.0, 1 + 2 ** -52, 2 - 2 ** -52) for sign in (1, -1)]
    values += [v for v in (struct.unpack("<d", rnd.randbytes(8))[0] for _ in range(5000)) if v == v]
    got = [r.v for r in images(spark.createDataFrame([(v,) for v in values], "v double"), ["v"]).collect()]
    bits = [struct.unpack("<q", struct.pack("<d", abs(v)))[0] for v in values]
    assert got == [-b if v < 0 else b for v, b in zip(values, bits)]
    assert [double_of(i) for i in got] == values


@pytest.mark.parametrize("seed", range(2))
def test_rounds_do_not_grow_with_the_spread(spark, seed, monkeypatch):
    rnd = random.Random(seed)
    values = [rnd.choice([1, -1]) * rnd.random() * 10.0 ** rnd.randint(-300, 300) for _ in range(20_001)]
    rounds, count = [], quantiles._count
    monkeypatch.setattr(quantiles, "_count", lambda *a: rounds.append(1) or count(*a))
    for q in (0.0, 0.25, 0.5, 1.0):
        rounds.clear()
        assert exact_quantiles(frame(spark, {"v": values}), ["v"], q)["v"] == pytest.approx(np.quantile(values, q), rel=1e-12)
        assert len(rounds) <= 5
    rounds.clear()
    close = {"v": [1.0 + k * 2 ** -52 for k in range(20_001)], "one": [7.0] * 20_000}
    assert exact_quantiles(frame(spark, close), ["v", "one"]) == {"v": 1.0 + 10_000 * 2 ** -52, "one": 7.0} and len(rounds) <= 5
