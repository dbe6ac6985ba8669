import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from linesmith.operators.features import (FEATURES, MONEY_FEATURES, clean_features,
                                          fit_cover_model, hit_rates, impute, labelled,
                                          learn_medians, qualifying, season_split)
from .conftest import rows


def newton(x, y, c=1.0):
    """Summed log loss plus |w|^2 / 2c with a free intercept, by Newton steps."""
    a = np.column_stack([x, np.ones(len(x))])
    penalty = np.diag([1 / c] * x.shape[1] + [0.0])
    w = np.zeros(a.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-a @ w))
        w -= np.linalg.solve(a.T @ (a * (p * (1 - p))[:, None]) + penalty,
                             a.T @ (p - y) + penalty @ w)
    return w


def random_games(seed, n=300):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        values = [rnd.choice([None, rnd.gauss(0, 5)]) if rnd.random() < 0.2 else rnd.gauss(0, 5)
                  for _ in FEATURES]
        values[3] = rnd.uniform(-50, 9000)
        values[5] = rnd.uniform(0, 9000)
        label = rnd.choice([None, 0, 1, 1]) if values[0] is None else int(values[0] + rnd.gauss(0, 6) > 0)
        out.append((2020 + i % 6, i, label, *values))
    return out


SCHEMA = "season int, id int, covered int, " + ", ".join(f"{f} double" for f in FEATURES)


def matrix(data, medians=None):
    """Features as the model should see them, by plain numpy."""
    data = [r for r in data if r[2] is not None]
    x = np.array([[np.nan if v is None else v for v in r[3:]] for r in data])
    for i, f in enumerate(FEATURES):
        if f in MONEY_FEATURES:
            x[:, i] = np.log1p(np.clip(x[:, i], 0, None))
    medians = np.nanmedian(x, axis=0) if medians is None else medians
    return np.where(np.isnan(x), medians, x), np.array([r[2] for r in data]), medians, data


def test_model_equals_an_independent_solution(spark):
    data = random_games(1)
    train, test = season_split(spark.createDataFrame(data, SCHEMA).repartition(4), "season", 2024)
    model = fit_cover_model(train)
    x, y, medians, _ = matrix([r for r in data if r[0] < 2024])
    assert [model.medians[f] for f in FEATURES] == pytest.approx(list(medians), rel=1e-12)
    mean, std = x.mean(axis=0), x.std(axis=0)
    w = newton((x - mean) / std, y)
    assert [model.weights[f] for f in FEATURES] == pytest.approx(list(w[:-1]), abs=1e-6)
    assert model.intercept == pytest.approx(w[-1], abs=1e-6)
    xt, _, _, kept = matrix([r for r in data if r[0] == 2024], medians)
    p = 1 / (1 + np.exp(-(((xt - mean) / std) @ w[:-1] + w[-1])))
    got = {r["id"]: r["prob"] for r in model.score(labelled(test)).collect()}
    assert got == pytest.approx({r[1]: v for r, v in zip(kept, p)}, abs=1e-6)


def test_scores_leave_rows_and_columns_alone(spark):
    df = spark.createDataFrame(random_games(2), SCHEMA)
    model = fit_cover_model(df.where("season < 2025"))
    scored = model.score(df)
    assert scored.columns == df.columns + ["prob"]
    assert rows(scored.drop("prob")) == rows(df)
    assert scored.where("prob is null").count() == 0  # unlabelled rows are scored too


def test_prepare(spark):
    df = spark.createDataFrame([("1.5", "-4", 1), ("x", "", None), (None, "1.718281828459045", 0),
                                ("2.5", "abc", 1)], "a string, m string, covered int")
    cleaned = clean_features(labelled(df), ["a", "m"], ["m"])
    assert rows(cleaned, "a", "m") == sorted([(1.5, 0.0), (None, 1.0), (2.5, None)], key=repr)
    medians = learn_medians(cleaned, ["a", "m"])
    assert medians == {"a": 2.0, "m": 0.5}
    assert rows(impute(cleaned, medians), "a", "m") == [(1.5, 0.0), (2.0, 1.0), (2.5, 0.5)]


def test_a_feature_without_values_is_named(spark):
    df = spark.createDataFrame([(1, "x", 1.0), (0, "", 2.0)], "covered int, bad string, ok double")
    with pytest.raises(ValueError, match="bad"):
        fit_cover_model(df, ["bad", "ok"], [])


def test_split_leaves_later_seasons_out(spark):
    train, test = season_split(spark.createDataFrame([(s,) for s in range(2020, 2026)], "season int"),
                               "season", 2023)
    assert rows(train) == [(2020,), (2021,), (2022,)] and rows(test) == [(2023,)]


def test_evaluation(spark):
    df = spark.createDataFrame([(0.51, 1), (0.52, 0), (0.63, 1), (0.63, 1), (None, 1), (0.9, None),
                                (float("nan"), None)], "prob double, covered int")
    assert rows(hit_rates(df, "prob", "covered", 0.1)) == [(5, 2, 0.5, False), (6, 2, 1.0, True)]
    edge = spark.createDataFrame([(0.6, 1), (0.55, 0)], "prob double, covered int")
    assert rows(hit_rates(edge, "prob", "covered", 0.05), "bucket") == [(11,), (12,)]
    assert rows(qualifying(df, "prob", 0.62)) == [(3, 7)]
    assert qualifying(df.where(F.lit(False)), "prob", 0.5).collect()[0]["total"] == 0
