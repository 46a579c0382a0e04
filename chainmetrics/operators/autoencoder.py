"""Auto-encoder outlier scores, trained data-parallel on Spark.

The net (d -> 25 -> 2 -> 2 -> 25 -> d, ReLU hidden layers, linear output) has a few hundred
parameters. An epoch is one Spark job: every partition runs mini-batch Adam steps through
all of its rows, beginning with the shared parameters, and the partitions' results are
averaged by rows. The averages are summed on the executors, one number per parameter, so
the driver gets as many numbers as there are parameters, however many partitions there are.
Epochs go on until the loss no longer falls (at most ``epochs``). The score of a row is the
Euclidean distance between the standardised row and its reconstruction; rows above the
(1 - contamination) percentile are flagged.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from chainmetrics.session import materialize, ship_package
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from chainmetrics.operators import features as FE
from chainmetrics.operators import outliers as O

# Fixed values of the reference configuration: hidden layer sizes.
HIDDEN = (25, 2, 2, 25)
#: Rows of a mini-batch.
BATCH = 32


def init_params(sizes, seed: int):
    rng = np.random.RandomState(seed)
    params = []
    for a, b in zip(sizes[:-1], sizes[1:]):
        lim = np.sqrt(6.0 / (a + b))
        params += [rng.uniform(-lim, lim, size=(a, b)), np.zeros(b)]
    return params


def forward(params, x):
    acts = [x]
    h = x
    n_layers = len(params) // 2
    for i in range(n_layers):
        z = h @ params[2 * i] + params[2 * i + 1]
        h = z if i == n_layers - 1 else np.maximum(z, 0.0)
        acts.append(h)
    return acts


def gradients(params, x):
    """Sum over rows of d(0.5 * ||x_hat - x||^2)/d(params), and the loss sum."""
    acts = forward(params, x)
    n_layers = len(params) // 2
    delta = acts[-1] - x
    loss = 0.5 * float((delta ** 2).sum())
    grads = [None] * len(params)
    for i in reversed(range(n_layers)):
        grads[2 * i] = acts[i].T @ delta
        grads[2 * i + 1] = delta.sum(axis=0)
        if i > 0:
            delta = (delta @ params[2 * i].T) * (acts[i] > 0)
    return grads, loss


def _flat(arrs):
    return np.concatenate([a.ravel() for a in arrs])


def _unflat(vec, like):
    out, pos = [], 0
    for a in like:
        out.append(vec[pos:pos + a.size].reshape(a.shape))
        pos += a.size
    return out


def _adam_epoch(params, moments, x, step: int, lr: float):
    """One pass of mini-batch Adam steps over the rows; returns (parameters, moments, step, loss sum before the steps)."""
    b1, b2, eps, total = 0.9, 0.999, 1e-8, 0.0
    m, v = moments
    for i in range(0, len(x), BATCH):
        part = x[i:i + BATCH]
        grads, loss = gradients(params, part)
        total += loss
        step += 1
        for j, g in enumerate(grads):
            g = g / len(part)
            m[j] = b1 * m[j] + (1 - b1) * g
            v[j] = b2 * v[j] + (1 - b2) * g * g
            params[j] = params[j] - lr * (m[j] / (1 - b1**step)) / (np.sqrt(v[j] / (1 - b2**step)) + eps)
    return params, (m, v), step, total


def fit_autoencoder(scaled: DataFrame, cols, hidden=HIDDEN, epochs: int = 100, lr: float = 0.003,
                    seed: int = 42, patience: int = 10, tolerance: float = 1e-3):
    """Parameters after the epochs that improved the loss. Stops when ``patience`` epochs in a
    row have not lowered the best loss by the share ``tolerance``."""
    sizes = (len(cols), *hidden, len(cols))
    params = init_params(sizes, seed)
    data = scaled.select(*[F.col(c).cast("double") for c in cols])
    best, best_params, since, width = np.inf, params, 0, len(_flat(params))
    state = np.concatenate((_flat(params), np.zeros(2 * width)))  # parameters and both moments
    steps = 0
    for _ in range(epochs):
        def epoch(batches, state=state, steps=steps):
            like = init_params(sizes, seed)
            p, m, v = (_unflat(state[i * width:(i + 1) * width].copy(), like) for i in range(3))
            n, loss, done = 0, 0.0, steps
            for pdf in batches:
                x = pdf.to_numpy(dtype=float)
                p, (m, v), done, part = _adam_epoch(p, (m, v), x, done, lr)
                loss += part
                n += len(x)
            if n:
                values = np.concatenate((_flat(p), _flat(m), _flat(v), [loss / n, (done - steps) / 1.0, 1.0])) * n
                yield pd.DataFrame({"pos": np.arange(len(values), dtype=np.int32), "value": values})

        # One row per parameter reaches the driver: the sums over the partitions.
        sums = data.mapInPandas(epoch, "pos INT, value DOUBLE").groupBy("pos").agg(F.sum("value").alias("value")).toPandas()
        if not len(sums):
            break
        mean = sums.sort_values("pos")["value"].to_numpy()
        mean = mean / mean[-1]
        loss, state, steps = mean[-3], mean[:-3], steps + int(round(mean[-2]))
        if loss < best * (1 - tolerance):
            best, since = loss, 0
        else:
            since += 1
        best_params = _unflat(state[:width].copy(), params)
        if since >= patience:
            break
    return best_params


def autoencoder_outliers(df: DataFrame, cols, hidden=HIDDEN, fraction: float = O.OUTLIER_FRACTION,
                         epochs: int = 100, lr: float = 0.003, seed: int = 42,
                         score: str = "score", flag: str = "anomaly", threshold: str = "percentile",
                         day_grain: bool = False) -> DataFrame:
    """Append the reconstruction-error score and a 0/1 outlier flag (H14). The cut is exact
    and distributed; ``day_grain`` takes it with a window over a small daily table."""
    ship_package(df.sparkSession)
    cols = list(cols)
    zcols = [f"_z_{c}" for c in cols]
    scaled = FE.standard_scale(df, cols, suffix="_zz")
    # Read once per epoch: stored in the shared folder, nothing stays cached.
    scaled = materialize(scaled.select(*df.columns, *[F.col(f"{c}_zz").alias(z) for c, z in zip(cols, zcols)]))
    params = fit_autoencoder(scaled, zcols, hidden, epochs, lr, seed)
    bparams = df.sparkSession.sparkContext.broadcast(params)

    @F.pandas_udf(DoubleType())
    def recon_error(*xs: pd.Series) -> pd.Series:
        x = np.column_stack([s.to_numpy(dtype=float) for s in xs])
        xh = forward(bparams.value, x)[-1]
        return pd.Series(np.sqrt(((xh - x) ** 2).sum(axis=1)))

    out = scaled.withColumn(score, recon_error(*[F.col(z) for z in zcols])).drop(*zcols)
    return O.flag_outliers(out, score, fraction, threshold, flag, strict=True, day_grain=day_grain)
