"""Feature scaling, projection and splitting.

Column statistics (mean, population std, min, max) are uncorrelated scalar
subqueries: Catalyst merges all of them over the same input into ONE
distributed aggregate and the scaled projection refers to the results, so no
cross join, no global window and nothing goes through the driver.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _stat(df: DataFrame, agg):
    return df.select(agg).scalar()


def standard_scale(df: DataFrame, cols, suffix: str = "") -> DataFrame:
    """(x - mean) / population std (H1); a constant column scales to 0."""
    out = df
    for c in cols:
        mean = _stat(df, F.avg(c))
        std = _stat(df, F.stddev_pop(c))
        scale = F.when(std == 0, F.lit(1.0)).otherwise(std)
        out = out.withColumn(c + suffix, (F.col(c) - mean) / scale)
    return out


def minmax_scale(df: DataFrame, cols, suffix: str = "") -> DataFrame:
    """(x - min) / (max - min) (H2); a constant column scales to 0."""
    out = df
    for c in cols:
        lo = _stat(df, F.min(c))
        hi = _stat(df, F.max(c))
        rng = F.when(hi == lo, F.lit(1.0)).otherwise(hi - lo)
        out = out.withColumn(c + suffix, (F.col(c).cast("double") - lo) / rng)
    return out


def hash_split(df: DataFrame, key: str, fraction: float = 0.7, seed: int = 4103,
               col: str = "is_train") -> DataFrame:
    """Deterministic train/test flag from a hash of the row key.

    Unlike ``randomSplit`` the result does not depend on partitioning or on
    re-computation after a lost executor.
    """
    bucket = F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(10_000))
    return df.withColumn(col, bucket < F.lit(int(round(fraction * 10_000))))


def md5_split(df: DataFrame, key: str, fraction: float = 0.7, col: str = "is_train") -> DataFrame:
    """Train/test flag from the md5 of the key as text: rows of one key stay together, and any
    SQL engine with md5 reproduces it (H12)."""
    head = F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("long")
    return df.withColumn(col, head % 10_000 < int(round(fraction * 10_000)))


def hash_share(hashed, share: float):
    """Rows whose 64-bit hash lies in the lowest ``share`` of its range (any share, however small)."""
    return hashed < F.lit(min(2**63 - 1, int(-(2**63) + 2**64 * share)))


def modulus_split(df: DataFrame, key: str, train_buckets: int = 7, buckets: int = 10,
                  col: str = "is_train") -> DataFrame:
    """Train/test flag ``key % buckets < train_buckets`` (reproducible in any SQL engine)."""
    return df.withColumn(col, F.pmod(F.col(key), F.lit(buckets)) < F.lit(train_buckets))


# -- PCA ---------------------------------------------------------------------------

def _cov_matrix(df: DataFrame, cols) -> tuple[np.ndarray, np.ndarray, int]:
    """Means and population covariance of ``cols`` from one aggregate row (d x d numbers)."""
    aggs = [F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)]
    aggs += [F.covar_pop(a, b).alias(f"c{i}_{j}") for i, a in enumerate(cols)
             for j, b in enumerate(cols) if j >= i]
    aggs.append(F.count(F.lit(1)).alias("n"))
    row = df.agg(*aggs).first()
    d = len(cols)
    mean = np.array([row[f"m{i}"] for i in range(d)], dtype=float)
    cov = np.zeros((d, d))
    for i in range(d):
        for j in range(i, d):
            cov[i, j] = cov[j, i] = row[f"c{i}_{j}"]
    return mean, cov, row["n"]


def pca_fit(df: DataFrame, cols, k: int = 2):
    """Principal axes of the centred data: (mean, components k x d, explained variance ratio).

    The covariance is one distributed aggregate; the d x d eigen problem is
    solved on the driver. Sign convention: the largest-magnitude loading of each
    component is positive.
    """
    mean, cov, _ = _cov_matrix(df, cols)
    vals, vecs = np.linalg.eigh(cov)
    order = np.argsort(vals)[::-1][:k]
    comps = vecs[:, order].T
    for r in range(comps.shape[0]):
        if comps[r, np.argmax(np.abs(comps[r]))] < 0:
            comps[r] = -comps[r]
    total = vals.sum()
    ratio = vals[order] / total if total > 0 else np.zeros(len(order))
    return mean, comps, ratio


def pca_project(df: DataFrame, cols, k: int = 2, prefix: str = "pc") -> DataFrame:
    """Append ``pc1..pck`` = centred features projected on the principal axes (H3)."""
    mean, comps, _ = pca_fit(df, cols, k)
    out = df
    for r in range(comps.shape[0]):
        expr = sum(((F.col(c) - float(mean[j])) * float(comps[r, j]) for j, c in enumerate(cols)),
                   F.lit(0.0))
        out = out.withColumn(f"{prefix}{r + 1}", expr)
    return out


def pca_report(df: DataFrame, cols, k: int = 2) -> DataFrame:
    """Per component: explained variance ratio and loadings, rounded to 4 places (H4)."""
    _, comps, ratio = pca_fit(df, cols, k)
    spark = df.sparkSession
    rows = [(f"Dimension {r + 1}", float(round(ratio[r], 4)),
             *[float(round(comps[r, j], 4)) for j in range(len(cols))]) for r in range(len(ratio))]
    schema = "dimension STRING, explained_variance DOUBLE, " + ", ".join(f"`{c}` DOUBLE" for c in cols)
    return spark.createDataFrame(rows, schema)


def assemble(df: DataFrame, cols, out: str = "features") -> DataFrame:
    """Feature columns -> one ML vector column (nulls kept as NaN)."""
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="keep").transform(df)


def vector_columns(df: DataFrame, vec: str, names) -> DataFrame:
    arr = vector_to_array(F.col(vec))
    return df.select("*", *[arr[i].alias(n) for i, n in enumerate(names)])
