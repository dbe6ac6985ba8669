"""Feature preparation, the cover model, its scores and its evaluation."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, functions as F

from ..functions.betting import BREAK_EVEN, confident
from ..functions.values import fill_with, log1p_money, to_double, zscore
from ..session import staged
from .quantiles import exact_quantiles

# Model inputs in order, those holding money, and the label.
FEATURES = ["opening_spread", "opening_moneyline", "spread_bet_pct", "spread_dollar_pct",
            "moneyline_bet_pct", "moneyline_dollar_pct", "line_movement"]
MONEY_FEATURES = ["spread_dollar_pct", "moneyline_dollar_pct"]
TARGET = "covered"


def season_split(df: DataFrame, season: str, test: int) -> tuple[DataFrame, DataFrame]:
    """Earlier seasons to train on and the test season; later ones in neither."""
    return df.where(F.col(season) < test), df.where(F.col(season) == test)


def clean_features(df: DataFrame, features=FEATURES, money=MONEY_FEATURES) -> DataFrame:
    """Numbers or null, money as log(1 + x)."""
    numbers = {f: to_double(f) for f in features}
    return df.withColumns({f: log1p_money(n) if f in money else n
                           for f, n in numbers.items()})


def labelled(df: DataFrame, target: str = TARGET) -> DataFrame:
    return df.where(F.col(target).isNotNull()).withColumn(target, F.col(target).cast("int"))


def learn_medians(cleaned: DataFrame, features=FEATURES) -> dict[str, float]:
    """Exact medians; a feature without any value is an error."""
    medians = exact_quantiles(cleaned, list(features), 0.5)
    empty = [f for f, m in medians.items() if m is None]
    if empty:
        raise ValueError(f"no value at all in feature(s): {', '.join(empty)}")
    return medians


def impute(cleaned: DataFrame, medians: dict[str, float]) -> DataFrame:
    return cleaned.withColumns({f: fill_with(f, m) for f, m in medians.items()})


@dataclass
class CoverModel:
    """Everything learnt on the training seasons, as plain numbers."""

    features: list[str]
    money: list[str]
    medians: dict[str, float]
    means: dict[str, float]
    stds: dict[str, float]
    rows: int
    weights: dict[str, float]
    intercept: float

    def score(self, df: DataFrame, prob: str = "prob") -> DataFrame:
        """Add P(label = 1); the input's rows and columns stay as they are.

        The whole model is one column expression: it compiles with the rest of
        the stage and needs neither vectors nor the training session.
        """
        margin = F.lit(self.intercept)
        for f in self.features:
            number = to_double(f)
            ready = fill_with(log1p_money(number) if f in self.money else number,
                              self.medians[f])
            margin = margin + zscore(ready, self.means[f], self.stds[f]) * self.weights[f]
        return df.withColumn(prob, 1 / (1 + F.exp(-margin)))


def _vectors(ready: DataFrame, features, means, stds, target: str) -> DataFrame:
    scaled = ready.select(target, *[zscore(f, means[f], stds[f]).alias(f) for f in features])
    return (VectorAssembler(inputCols=list(features), outputCol="__x")
            .transform(scaled).select("__x", target))


def scale_stats(df: DataFrame, features) -> tuple[dict, dict, int]:
    """Mean and population deviation of each feature, and the row count."""
    row = df.agg(F.count(F.lit(1)).alias("rows"), *[e for f in features for e in (
        F.avg(f).alias(f"m_{f}"), F.stddev_pop(f).alias(f"s_{f}"))]).first()
    return ({f: row[f"m_{f}"] for f in features},
            {f: row[f"s_{f}"] for f in features}, row["rows"])


def fit_cover_model(train: DataFrame, features=FEATURES, money=MONEY_FEATURES,
                    target: str = TARGET, c: float = 1.0) -> CoverModel:
    """Standardised logistic regression with an L2 penalty of strength 1/c.

    The summed log loss plus ``|w|^2 / 2c`` equals Spark's mean loss with
    ``regParam = 1 / (c * rows)`` once its own scaling is off. The narrow
    cleaned table is stored once: medians, scaling and fit all read it.
    """
    features, money = list(features), list(money)
    needed = labelled(train, target).select(*dict.fromkeys([*features, target]))
    cleaned = staged(clean_features(needed, features, money), "features")
    medians = learn_medians(cleaned, features)
    ready = impute(cleaned, medians)
    means, stds, rows = scale_stats(ready, features)
    logit = LogisticRegression(
        featuresCol="__x", labelCol=target, regParam=1.0 / (c * rows), elasticNetParam=0.0,
        standardization=False, maxIter=1000, tol=1e-10,
    ).fit(_vectors(ready, features, means, stds, target))
    return CoverModel(features, money, medians, means, stds, rows,
                      dict(zip(features, map(float, logit.coefficients))),
                      float(logit.intercept))


def hit_rates(scored: DataFrame, prob: str, target: str, width: float = 0.05,
              bar: float = BREAK_EVEN) -> DataFrame:
    """Share of covers per probability bucket against the break-even bar.

    The quotient is rounded to nine places first: 0.6 / 0.05 is a little below 12.
    """
    bucket = F.floor(F.round(F.col(prob) / F.lit(width), 9)).cast("int")
    rates = (scored.where(F.col(target).isNotNull() & F.col(prob).isNotNull())
             .groupBy(bucket.alias("bucket"))
             .agg(F.count(F.lit(1)).alias("rows"), F.avg(target).alias("hit_rate")))
    return rates.withColumn("beats_bar", F.col("hit_rate") > F.lit(bar))


def qualifying(scored: DataFrame, prob: str, threshold: float) -> DataFrame:
    """How many rows pass the confidence threshold, and how many there are."""
    return scored.agg(F.count_if(confident(prob, threshold)).alias("qualifying"),
                      F.count(F.lit(1)).alias("total"))
