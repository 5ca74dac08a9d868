"""Statistical modelling: M1-M5.

OLS takes means and centred covariances of all features in one aggregate over
all partitions, so only a k x k matrix reaches the driver (Spark ML's normal
solver is the alternative).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def _q(name: str) -> str:
    return f"`{name}`"


def split_flag(df: DataFrame, key_cols: Sequence[str], test_fraction: float = 0.2,
               seed: int = 42, name: str = "is_test") -> DataFrame:
    """M1: deterministic train/test assignment by hashing a key with a seed.

    Unlike ``randomSplit``, the assignment does not change with partitioning or
    task retries. Row-for-row equality with a seeded in-memory shuffle is not
    possible; the proportion is.
    """
    h = F.pmod(F.xxhash64(F.lit(seed), *[F.col(_q(c)) for c in key_cols]), F.lit(1_000_000))
    return df.withColumn(name, h < F.lit(int(test_fraction * 1_000_000)))


def split_exact(df: DataFrame, key_cols: Sequence[str], test_fraction: float = 0.2, seed: int = 42,
                name: str = "is_test", mark: Column | None = None) -> DataFrame:
    """M1: exactly ``ceil(test_fraction * rows)`` test rows, those of the smallest marks.

    A row's ``mark`` is a 64-bit number, by default a seeded hash of its key, so the split depends
    neither on partitioning nor on retries. The last test mark is found by counting rows
    per 16 bits of it, at most four passes over the marks and 65,536 counts each; of the
    rows that share it, as many as are still needed are taken in order of their key.
    """
    shifted = (mark if mark is not None else F.xxhash64(F.lit(seed), *[F.col(_q(c)) for c in key_cols])).cast("long")
    # Unsigned order: the sign bit turned.
    marked = df.withColumn("__mark", shifted.bitwiseXOR(F.lit(-1 << 63)))
    wanted = math.ceil(test_fraction * df.count())
    if not wanted:
        return df.withColumn(name, F.lit(False))
    prefix, missing = 0, wanted
    for shift in (48, 32, 16, 0):
        part = F.shiftrightunsigned("__mark", shift)
        inside = marked if shift == 48 else marked.filter(F.shiftrightunsigned("__mark", shift + 16) == prefix)
        # 65,536 counts at most
        counts = {r["b"]: r["n"] for r in inside.groupBy(part.bitwiseAND(F.lit(0xFFFF)).alias("b")).agg(F.count("*").alias("n")).collect()}
        for bucket in sorted(counts):
            if missing <= counts[bucket]:
                break
            missing -= counts[bucket]
        prefix = (prefix << 16) | bucket
    last = prefix - (1 << 64) if prefix >= 1 << 63 else prefix
    # The two halves compare as unsigned numbers.
    low = (F.shiftrightunsigned("__mark", 32) < (prefix >> 32)) | (
        (F.shiftrightunsigned("__mark", 32) == (prefix >> 32)) & (F.col("__mark").bitwiseAND(F.lit(0xFFFFFFFF)) < (prefix & 0xFFFFFFFF)))
    clear = marked.filter(F.col("__mark") != last).withColumn(name, low)
    ties = marked.filter(F.col("__mark") == last)
    place = F.row_number().over(Window.partitionBy("__mark").orderBy(*[F.col(_q(c)) for c in key_cols]))
    return clear.unionByName(ties.withColumn(name, place <= missing)).drop("__mark")


class OlsModel:
    """A fitted linear model: ``intercept + sum(coef_i * x_i)``. Prediction is a
    plain column expression, so scoring stays inside whole-stage codegen."""

    def __init__(self, features: Sequence[str], coefficients: Sequence[float], intercept: float):
        self.features = list(features)
        self.coefficients = [float(c) for c in coefficients]
        self.intercept = float(intercept)

    def prediction(self):
        expr = F.lit(self.intercept)
        for f, c in zip(self.features, self.coefficients):
            expr = expr + F.lit(c) * F.col(_q(f)).cast("double")
        return expr


def fit_ols(train: DataFrame, features: Sequence[str], label: str, engine: str = "normal"):
    """M2: ordinary least squares with intercept, no regularisation, rows with a
    null feature or label dropped.

    ``engine="normal"``: one aggregate of means and centred covariances, the
    driver solves the small k x k system. ``engine="ml"``: Spark ML's normal-equation
    solver (same result, more passes)."""
    if engine == "normal":
        coefs, intercept = ols_normal_equations(train, features, label)
        return OlsModel(features, coefs, intercept)
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    clean = train.select(*[F.col(_q(c)).cast("double").alias(c) for c in features],
                         F.col(_q(label)).cast("double").alias(label)).na.drop()
    assembled = VectorAssembler(inputCols=list(features), outputCol="__features").transform(clean)
    lr = LinearRegression(featuresCol="__features", labelCol=label, solver="normal",
                          regParam=0.0, elasticNetParam=0.0, fitIntercept=True,
                          standardization=False)
    m = lr.fit(assembled)
    return OlsModel(features, m.coefficients.toArray().tolist(), m.intercept)


def score(model: OlsModel, df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """M3: (actual, predicted) for each row."""
    return df.select(F.col(_q(label)).cast("double").alias("actual"), model.prediction().alias("predicted"))


def regression_metrics(scored: DataFrame, actual: str = "actual",
                       predicted: str = "predicted") -> DataFrame:
    """M4: MSE, RMSE and R^2 in one aggregate."""
    err = F.col(actual) - F.col(predicted)
    stats = scored.agg(F.avg(err * err).alias("mse"),
                       F.sum(err * err).alias("sse"),
                       F.var_pop(F.col(actual)).alias("var_y"),
                       F.count(F.lit(1)).alias("n"))
    return stats.select(
        F.col("mse"), F.sqrt("mse").alias("rmse"),
        (F.lit(1.0) - F.try_divide(F.col("sse"), F.col("var_y") * F.col("n"))).alias("r2"),
        F.col("n"))


def coefficient_table(spark: SparkSession, model: OlsModel, features: Sequence[str] | None = None) -> DataFrame:
    """M5: (feature, coefficient) rows plus the intercept; k+1 values."""
    rows = list(zip(model.features, model.coefficients))
    rows.append(("intercept", model.intercept))
    return spark.createDataFrame(rows, "feature string, coefficient double")


def ols_single(df: DataFrame, x: str, y: str, keys: Sequence[str] = ()) -> DataFrame:
    """M2 for one feature, as SQL aggregates (``regr_slope`` / ``regr_intercept``),
    optionally per group; pairs with a null are skipped."""
    aggs = [F.regr_slope(F.col(_q(y)), F.col(_q(x))).alias("slope"),
            F.regr_intercept(F.col(_q(y)), F.col(_q(x))).alias("intercept"),
            F.regr_r2(F.col(_q(y)), F.col(_q(x))).alias("r2"),
            F.regr_count(F.col(_q(y)), F.col(_q(x))).alias("n")]
    return df.groupBy(*[F.col(_q(k)) for k in keys]).agg(*aggs) if keys else df.agg(*aggs)


def ols_normal_equations(df: DataFrame, features: Sequence[str], label: str) -> tuple[list[float], float]:
    """M2: least squares from one aggregate. Rows with a null feature or label are
    dropped (listwise); the aggregate returns the means and the centred
    (co)variances ``covar_pop`` (numerically stable, merged across partitions);
    the driver solves the k x k system ``Cov(X) beta = Cov(X, y)`` and sets
    ``intercept = mean(y) - beta . mean(X)``."""
    import numpy as np

    k = len(features)
    src = df.select(*[F.col(_q(c)).cast("double").alias(f"x{i}") for i, c in enumerate(features)],
                    F.col(_q(label)).cast("double").alias("y")).na.drop()
    aggs = [F.avg("y").alias("my")]
    for i in range(k):
        aggs.append(F.avg(f"x{i}").alias(f"m{i}"))
        aggs.append(F.covar_pop(f"x{i}", "y").alias(f"cy{i}"))
        for j in range(i, k):
            aggs.append(F.covar_pop(f"x{i}", f"x{j}").alias(f"c{i}_{j}"))
    r = src.agg(*aggs).first()
    cov = np.zeros((k, k))
    for i in range(k):
        for j in range(i, k):
            cov[i, j] = cov[j, i] = r[f"c{i}_{j}"]
    # Least squares: constant or collinear features get the solution of least norm.
    beta = np.linalg.lstsq(cov, np.array([r[f"cy{i}"] for i in range(k)]), rcond=None)[0]
    intercept = r["my"] - float(np.dot(beta, [r[f"m{i}"] for i in range(k)]))
    return [float(b) for b in beta], float(intercept)
