"""Illicit-address classifiers: exact kNN, decision tree, boosted trees; scoring and reports.

Exact kNN, row-local
--------------------
The training rows are broadcast in blocks of at most about ``block_rows`` (a block is
counted before it is collected, so its size is proven; a training set of that size is one
block). One ``mapInArrow`` pass over the query rows takes the blocks in turn and keeps the k best
neighbours seen so far, then votes. A block is dealt into boxes of near rows: a box farther than
the k-th neighbour so far is ruled out, the others are compared row by row. Query rows are
never shuffled, grouped or joined, so the work is linear in them, and rows with equal ids
or equal features are simply rows of their own. Results equal those of all pairs. Null and NaN features count as 0, as after the reference's null fill.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StructField, StructType

from chainmetrics.operators import binary_boosting as BB
from chainmetrics.operators import binned_tree as BT
from chainmetrics.operators.features import hash_share
from chainmetrics.session import materialize, path_exists, ship_package

# Fixed values of the reference models: k = 4 neighbours with inverse-distance
# weights; entropy tree with seed 0; 100 boosting rounds at learning rate 0.5;
# 70/30 split with seed 4103.
KNN_K = 4
TREE_SEED = 0
BOOST_ROUNDS = 100
BOOST_RATE = 0.5
SPLIT_SEED = 4103
TRAIN_FRACTION = 0.7

BLOCK_ROWS = 65_536
#: Query rows for which all blocks are read once.
ASK_ROWS = 20_000
#: Rows of a box of near training rows; with more dimensions than these there are no boxes.
LEAF_ROWS = 256
BOX_DIMENSIONS = 16
#: Cells of the distance matrix held at once.
CHUNK_CELLS = 1 << 21
NEIGHBOUR = StructType([StructField("dist", DoubleType()), StructField("tid", LongType()), StructField("tlabel", IntegerType())])


def _as_array(df: DataFrame, features) -> DataFrame:
    """Append the features as ``_x array<double>``, nulls and NaN as 0."""
    x = F.col(features).cast("array<double>") if isinstance(features, str) else F.array(*[F.col(c).cast("double") for c in features])
    return df.withColumn("_x", F.transform(x, lambda v: F.coalesce(F.nanvl(v, F.lit(0.0)), F.lit(0.0))))


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of a batch as rows; a null vector is all zero."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    if len(column) and not column.null_count and (lengths == lengths[0]).all():
        return np.asarray(column.flatten(), dtype=float).reshape(len(column), -1)
    rows = column.to_pylist()
    width = max((len(r) for r in rows if r), default=0)
    out = np.zeros((len(rows), width))
    for i, r in enumerate(rows):
        if r:
            out[i, :len(r)] = r
    return out


class _Block:
    """One block of training rows, in boxes of near rows; within a box in the order of their ids."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, labels: np.ndarray, k: int):
        x, ids, labels = _least_ids(x, ids, labels, k)
        order = np.argsort(ids, kind="stable")
        boxes = _boxes(x[order]) if len(x) > 2 * LEAF_ROWS else [np.arange(len(x))]
        at = order[np.concatenate(boxes)] if len(x) else order
        self.x, self.ids, self.labels, self.k = x[at], ids[at], labels[at], k
        self.starts = np.cumsum([0, *map(len, boxes)])
        self.square = (self.x**2).sum(1)
        if len(boxes) > 1:
            self.low, self.high = (f.reduceat(self.x, self.starts[:-1], axis=0) for f in (np.minimum, np.maximum))

    def nearest(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rows of the block, distances) of the k nearest by (distance, id), nearest first."""
        at, dist, _ = self.search(q)
        return at, dist

    def search(self, q: np.ndarray, reach: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As ``nearest``, and the number of rows that every query row was compared with. Neighbours
        farther than ``reach`` need not be found (their distance is infinite)."""
        width = max(q.shape[1], self.x.shape[1])
        q = np.pad(q, ((0, 0), (0, width - q.shape[1])))
        x = np.pad(self.x, ((0, 0), (0, width - self.x.shape[1]))) if width > self.x.shape[1] else self.x
        k, n = min(self.k, len(x)), len(x)
        at, dist, compared = np.zeros((len(q), k), np.int64), np.full((len(q), k), np.inf), np.zeros(len(q), np.int64)
        if not k:
            return at, dist, compared
        reach = np.full(len(q), np.inf) if reach is None else reach
        if len(self.starts) == 2:
            self._compare(q, np.arange(len(q)), x, 0, n, at, dist, compared, reach)
            return at, dist, compared
        low, high = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (self.low, self.high))
        step = max(1, CHUNK_CELLS // len(low))
        for s in range(0, len(q), step):
            part = q[s:s + step]
            gap = np.zeros((len(part), len(low)))
            for d in range(width):
                side = np.maximum(np.maximum(low[:, d] - part[:, d, None], part[:, d, None] - high[:, d]), 0)
                gap += side * side
            gap = np.sqrt(gap)
            # Nearest box first; then all boxes no farther than the k-th so far (rounding must not rule out the very distance).
            home = gap.argmin(1)
            gap_home = np.take_along_axis(gap, home[:, None], 1)[:, 0]
            np.put_along_axis(gap, home[:, None], np.inf, 1)
            self._visit(part, s, np.arange(len(part)), home, gap_home, x, at, dist, compared, reach)
            near = gap <= np.minimum(dist[s:s + len(part), -1], reach[s:s + len(part)])[:, None] * (1 + 1e-9) + 1e-12
            ask, box = np.nonzero(near)
            self._visit(part, s, ask, box, gap[ask, box], x, at, dist, compared, reach)
        return at, dist, compared

    def _visit(self, part, s, ask, box, gap, x, at, dist, compared, reach) -> None:
        """Compare pairs (query row, box), nearest boxes first, box by box within a round; by the time
        a farther box comes, the k-th distance may have ruled it out."""
        order = np.lexsort((gap, ask))
        ask, box, gap = ask[order], box[order], gap[order]
        first = np.flatnonzero(np.r_[True, ask[1:] != ask[:-1]]) if len(ask) else np.zeros(0, np.int64)
        turn = np.arange(len(ask)) - np.repeat(first, np.diff(np.r_[first, len(ask)]))
        order = np.lexsort((box, np.floor(np.log2(turn + 1)).astype(int)))
        ask, box, gap, turn = ask[order], box[order], gap[order], np.floor(np.log2(turn[order] + 1)).astype(int)
        cut = np.flatnonzero(np.r_[True, (box[1:] != box[:-1]) | (turn[1:] != turn[:-1])]) if len(ask) else []
        for i, j in zip(cut, [*cut[1:], len(ask)]):
            rows = s + ask[i:j]
            rows = rows[gap[i:j] <= np.minimum(dist[rows, -1], reach[rows]) * (1 + 1e-9) + 1e-12]
            if len(rows):
                self._compare(part[rows - s], rows, x, self.starts[box[i]], self.starts[box[i] + 1], at, dist, compared, reach)

    def _compare(self, part, rows, x, begin, end, at, dist, compared, reach) -> None:
        """Merge the rows ``begin`` to ``end`` of the block into what was found for query rows."""
        k, x, square = at.shape[1], x[begin:end], self.square[begin:end]
        step = max(1, CHUNK_CELLS // len(x))
        for s in range(0, len(part), step):
            p, r = part[s:s + step], rows[s:s + step]
            # Squared distances by a matrix product: rough, used only to drop what is clearly farther.
            own = (p**2).sum(1)
            rough = own[:, None] + square - 2 * p @ x.T
            slack = 1e-9 * (own + square.max(initial=0)) + 1e-12
            kth = np.minimum(dist[r, -1], reach[r]) ** 2
            if len(x) >= k:
                kth = np.minimum(kth, np.partition(rough, k - 1, 1)[:, k - 1])
            i, c = np.nonzero(rough <= (kth + 2 * slack)[:, None])
            d = np.sqrt(((x[c] - p[i]) ** 2).sum(1))
            # What was found so far and what is new, by (row, distance, id).
            had = np.isfinite(dist[r])
            who = np.r_[np.nonzero(had)[0], i]
            d, c = np.r_[dist[r][had], d], np.r_[at[r][had], begin + c]
            order = np.lexsort((self.ids[c], d, who))
            who, d, c = who[order], d[order], c[order]
            first = np.flatnonzero(np.r_[True, who[1:] != who[:-1]]) if len(who) else np.zeros(0, np.int64)
            place = np.arange(len(who)) - np.repeat(first, np.diff(np.r_[first, len(who)]))
            best = place < k
            at[r[who[best]], place[best]], dist[r[who[best]], place[best]] = c[best], d[best]
            compared[r] += len(x)


def _least_ids(x: np.ndarray, ids: np.ndarray, labels: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of rows with equal vectors, those that can be among the k nearest: the k smallest ids (of rows with
    equal ids, the first)."""
    if len(x) <= k or x.shape[1] > BOX_DIMENSIONS:
        return x, ids, labels
    order = np.lexsort((ids, *x.T[::-1]))
    first = np.flatnonzero(np.r_[True, (x[order[1:]] != x[order[:-1]]).any(1)])
    place = np.arange(len(x)) - np.repeat(first, np.diff(np.r_[first, len(x)]))
    kept = np.sort(order[place < k])
    return (x, ids, labels) if len(kept) == len(x) else (x[kept], ids[kept], labels[kept])


def _boxes(x: np.ndarray) -> list[np.ndarray]:
    """Rows in boxes of at most ``LEAF_ROWS``, halved at the median of the widest dimension; in
    many dimensions boxes rule nothing out, and all rows are one."""
    if x.shape[1] > BOX_DIMENSIONS:
        return [np.arange(len(x))]
    todo, out = [np.arange(len(x))], []
    while todo:
        rows = todo.pop()
        if len(rows) <= LEAF_ROWS:
            out.append(np.sort(rows))
            continue
        part = x[rows]
        d = int(np.argmax(part.max(0) - part.min(0)))
        order = np.argpartition(part[:, d], len(rows) // 2)
        todo += [rows[order[:len(rows) // 2]], rows[order[len(rows) // 2:]]]
    return out


def _training_blocks(train: DataFrame, features, label: str, id_col: str, k: int, block_rows: int) -> list[_Block]:
    """The training rows in blocks; each is collected only after its size is known to be bounded."""
    rows = materialize(_as_array(train, features).select(
        F.col(id_col).cast("long").alias("id"), "_x", F.col(label).cast("int").alias("label"), F.monotonically_increasing_id().alias("row"))
        .where("id is not null and label is not null"))
    blocks = max(1, math.ceil(rows.count() / block_rows))
    for b in range(blocks):
        got = rows.where(F.pmod(F.xxhash64("row"), F.lit(blocks)) == b).toArrow().combine_chunks()
        if got.num_rows:
            yield _Block(_matrix(got.column("_x")), got.column("id").to_numpy(), got.column("label").to_numpy(), k)


def _pass(df: DataFrame, blocks: list[_Block], k: int, prediction: str) -> DataFrame:
    """Append the neighbours over all blocks, ``_nn``, and their vote. A task holds one block and some query rows at a time."""
    shared = [df.sparkSession.sparkContext.broadcast(b) for b in blocks]
    kept = [f for f in df.schema.fields if f.name != prediction]
    schema, names = StructType([*kept, StructField("_nn", ArrayType(NEIGHBOUR)), StructField(prediction, IntegerType())]), df.columns
    arrow, x_at = to_arrow_schema(schema), names.index("_x")

    def asked(batches):
        held, rows = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                rows += batch.num_rows
            if rows >= ASK_ROWS:
                yield held
                held, rows = [], 0
        if held:
            yield held

    def run(batches):
        for held in asked(batches):
            q = [_matrix(b.column(x_at)) for b in held]
            width = max(m.shape[1] for m in q)
            q = np.concatenate([np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in q])
            # The k best so far of every row: distance, id and label.
            best = [np.zeros((len(q), 0), t) for t in (float, np.int64, np.int32)]
            for one in shared:
                block = one.value
                at, dist, _ = block.search(q, best[0][:, -1] if best[0].shape[1] == k else None)
                best = [np.concatenate(v, 1) for v in zip(best, (dist, block.ids[at], block.labels[at]))]
                order = np.lexsort((best[1], best[0]), axis=1)[:, :k]
                best = [np.take_along_axis(v, order, 1) for v in best]
                if len(shared) > 1:
                    block = None
                    del one._value  # read again from its file for the next rows: blocks don't add up
            ends = np.cumsum([b.num_rows for b in held])[:-1]
            for batch, *found in zip(held, *[np.split(v, ends) for v in best]):
                nn = [[{"dist": d, "tid": t, "tlabel": y} for d, t, y in zip(*r)] for r in zip(*(v.tolist() for v in found))]
                out = [batch.column(names.index(f.name)) for f in kept]
                out += [pa.array(nn, arrow.field("_nn").type), pa.array([vote(r) for r in nn], pa.int32())]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) if c.type != f.type else c for c, f in zip(out, arrow)], schema=arrow)

    return df.mapInArrow(run, schema)


def vote(neighbours: list[dict]) -> int | None:
    """Inverse-distance vote; if any neighbour is at distance 0, only those vote (weight 1
    each). Ties go to the smaller label; no neighbours, no vote."""
    exact = any(v["dist"] == 0 for v in neighbours)
    weight: dict[int, float] = {}
    for v in neighbours:
        weight[v["tlabel"]] = weight.get(v["tlabel"], 0.0) + (float(v["dist"] == 0) if exact else 1.0 / v["dist"])
    return min(weight, key=lambda y: (-weight[y], y)) if weight else None


def _with_neighbours(train: DataFrame, queries: DataFrame, features, label: str, id_col: str, k: int, block_rows: int,
                     prediction: str) -> DataFrame:
    ship_package(train.sparkSession)
    queries.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    blocks = list(_training_blocks(train, features, label, id_col, k, block_rows))
    return _pass(_as_array(queries, features), blocks, k, prediction)


def knn_neighbours(train: DataFrame, queries: DataFrame, features, label: str, id_col: str,
                   k: int = KNN_K, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(qid, tid, tlabel, dist, rank) of the k nearest training rows of every query row."""
    found = _with_neighbours(train, queries.select(*queries.columns), features, label, id_col, k, block_rows, "_vote")
    return (found.select(F.col(id_col).cast("long").alias("qid"), F.posexplode("_nn").alias("pos", "n"))
            .select("qid", "n.tid", "n.tlabel", "n.dist", (F.col("pos") + 1).alias("rank")))


def knn_classify(train: DataFrame, queries: DataFrame, features, label: str, id_col: str,
                 k: int = KNN_K, block_rows: int = BLOCK_ROWS, prediction: str = "prediction") -> DataFrame:
    """Append the exact k-nearest-neighbour class to every row of ``queries`` (H9)."""
    return _with_neighbours(train, queries, features, label, id_col, k, block_rows, prediction).drop("_x", "_nn")


# -- tree models -----------------------------------------------------------------

def _few_parts(train: DataFrame) -> DataFrame:
    """As many parts as tasks run at a time; the draw of the rows that set the bins depends on them."""
    return train.coalesce(train.sparkSession.sparkContext.defaultParallelism)


def fit_tree(train: DataFrame, features, label: str = "label", max_depth: int = 30,
             seed: int = TREE_SEED, prediction: str = "y_dtc_pred") -> BT.Model:
    """Entropy decision tree (H10) as MLlib's, with 32 bins of a feature and at most 30 levels."""
    return BT.fit(_few_parts(train), features, label, max_depth, prediction, seed)


def fit_boosted(train: DataFrame, features, label: str = "label", rounds: int = BOOST_ROUNDS,
                rate: float = BOOST_RATE, max_depth: int = 6, seed: int = TREE_SEED,
                prediction: str = "y_xgb_pred") -> BB.Model:
    """Gradient-boosted trees, binary (H11), as MLlib's but on packed blocks of rows."""
    return BB.fit(_few_parts(train), features, label, rounds, rate, max_depth, prediction, seed)


def apply_model(model: BT.Model | BB.Model, df: DataFrame, prediction: str) -> DataFrame:
    """Append the model's prediction as an int column, dropping the helper columns."""
    out = model.transform(df)
    drop = [c for c in out.columns if c.startswith("_") and c not in df.columns]
    return out.withColumn(prediction, F.col(prediction).cast("int")).drop(*drop)


def save_model(model: BT.Model | BB.Model, path: str) -> None:
    """Model store (A13), overwrite: the tables of the tree or trees."""
    model.save(SparkSession.active(), path)


def load_model(path: str) -> BT.Model | BB.Model:
    spark = SparkSession.active()
    return (BB if path_exists(spark, f"{path}/trees") else BT).load(spark, path)


def bounded_training_rows(train: DataFrame, key: str, rows: int) -> DataFrame:
    """At most about ``rows`` of the labelled rows, whole keys by their hash, for trial fits. No registered
    query uses it: their models learn from all training rows."""
    n = train.count()
    return train if n <= rows else train.where(hash_share(F.xxhash64(F.col(key), F.lit(31)), rows / n))


def store_models(path: str, train: DataFrame, tree: BT.Model, boosted: BB.Model) -> None:
    """Store all three models below ``path`` (A13): the kNN model is its training table, the
    tree and the boosted trees are tables; ``registry`` lists them."""
    train.write.mode("overwrite").parquet(f"{path}/knn")
    save_model(tree, f"{path}/dtc")
    save_model(boosted, f"{path}/xgb")
    (train.sparkSession.createDataFrame([("knn", "table"), ("dtc", "tree"), ("xgb", "trees")], "model STRING, kind STRING")
     .coalesce(1).write.mode("overwrite").parquet(f"{path}/registry"))


def load_models(spark, path: str) -> tuple[DataFrame, BT.Model, BB.Model]:
    """(training table of the kNN, decision tree, boosted trees) from a model store."""
    kinds = {r.model for r in spark.read.parquet(f"{path}/registry").collect()}
    if kinds != {"knn", "dtc", "xgb"}:
        raise ValueError(f"{path} holds {sorted(kinds)}")
    return spark.read.parquet(f"{path}/knn"), load_model(f"{path}/dtc"), load_model(f"{path}/xgb")


# -- scoring and reports ---------------------------------------------------------

def score_all_models(df: DataFrame, train: DataFrame, features, label: str, id_col: str,
                     tree: BT.Model | None = None, boosted: BB.Model | None = None,
                     k: int = KNN_K) -> DataFrame:
    """Apply kNN, tree and boosted trees to every row; nulls -> 0 (H13, B19). The neighbours are found by
    cells, as the training rows may be too many to be broadcast."""
    from chainmetrics.operators import kdtree as KD

    out = KD.knn_classify(train, df, features, label, id_col, k, prediction="y_knn_pred").drop("n_distances")
    if tree is not None:
        out = apply_model(tree, out, "y_dtc_pred")
    if boosted is not None:
        out = apply_model(boosted, out, "y_xgb_pred")
    preds = [c for c in ("y_knn_pred", "y_dtc_pred", "y_xgb_pred") if c in out.columns]
    return out.fillna(0, subset=preds)


def confusion_metrics(label: str, prediction: str, positive: int = 1, prefix: str = "",
                      where=None):
    """Aggregate expressions over the rows where ``where`` holds: accuracy,
    precision, recall and F1 of ``positive`` (one-vs-rest). An empty
    denominator gives 0; F1 = 2tp / (2tp + fp + fn)."""
    y, p = F.col(label), F.col(prediction)
    cond = F.lit(True) if where is None else where

    def count(c):
        return F.sum((cond & c).cast("long"))

    tp = count((y == positive) & (p == positive))
    fp = count((y != positive) & (p == positive))
    fn = count((y == positive) & (p != positive))
    correct = count(y == p)
    n = F.sum(cond.cast("long"))

    def ratio(a, b):
        return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))

    return [ratio(correct, n).alias(f"{prefix}acc"), ratio(tp, tp + fp).alias(f"{prefix}precision"),
            ratio(tp, tp + fn).alias(f"{prefix}recall"), ratio(2 * tp, 2 * tp + fp + fn).alias(f"{prefix}f1score")]


def classification_report(df: DataFrame, label: str, prediction: str, split_col: str = "is_train",
                          model: str = "model", positive: int = 1) -> DataFrame:
    """One row: model, train_* and test_* accuracy, precision, recall, F1.

    A single aggregation pass with conditional sums for both splits.
    """
    split = F.col(split_col)
    return df.agg(*confusion_metrics(label, prediction, positive, "train_", split),
                  *confusion_metrics(label, prediction, positive, "test_", ~split)
                  ).select(F.lit(model).alias("model"), "*")
