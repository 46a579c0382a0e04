"""Exact kNN over a kd-tree of cells (C10, H9), for training sets of any size.

The tree's splits (widest dimension, median) come from a bounded sample of training rows; every
training row falls into one cell, and every cell keeps the box of its rows. A query row
is compared with its home cell first. Its k-th distance then rules out every cell whose box
is farther; only the others are searched in a second round, and the neighbours of
both rounds are merged. Equal query rows of a task are searched once; of equal training rows, the
k smallest ids are. Results are exact, and equal to comparing all pairs.

Rows meet by (cell, part, share): a cell of many rows is dealt to parts of at most about
``PART_ROWS`` training rows, a cell of many queries to shares of ``SHARE_ROWS``, so no task holds a
whole hot cell, however many equal rows it has. Boxes and counts, one row per
cell, are all that reaches the driver; the number of cells is a parameter.

Null and NaN components count as 0, equal distances go to the smaller id, training rows without
id or label don't take part, query rows may repeat. Without training rows nothing is found.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from chainmetrics.operators.classify import KNN_K, _as_array, _Block, hash_share
from chainmetrics.session import materialize, ship_package

#: Training rows from which the splits are drawn at most.
SAMPLE_ROWS = 50_000
CELLS = 256
PART_ROWS = 50_000
SHARE_ROWS = 100_000
#: Rows and cells for which gaps are worked out at once.
REACH_ROWS = 1024
REACH_CELLS = 1024
_FOUND = "qid long, nn array<struct<dist: double, tid: long, tlabel: int>>, n_distances long"


@dataclass
class Cells:
    """A kd-tree in heap order: split dimension (-1: leaf) and value of each node; leaves are cells."""

    dimension: np.ndarray
    value: np.ndarray

    @classmethod
    def build(cls, sample: np.ndarray, cells: int, least: int) -> Cells:
        depth = max(0, math.ceil(math.log2(max(1, cells))))
        tree = cls(np.full(2 ** (depth + 1) - 1, -1), np.zeros(2 ** (depth + 1) - 1))
        todo = [(0, np.arange(len(sample)), depth)]
        while todo:
            node, rows, left = todo.pop()
            if left == 0 or len(rows) < 2 * least:
                continue
            x = sample[rows]
            d = int(np.argmax(x.max(0) - x.min(0)))
            middle = float(np.median(x[:, d]))
            low = x[:, d] <= middle
            if low.all():  # many equal values: split below them, if there is anything
                middle = float(np.nextafter(middle, -np.inf))
                low = x[:, d] <= middle
                if not low.any():
                    continue
            tree.dimension[node], tree.value[node] = d, middle
            todo += [(2 * node + 1, rows[low], left - 1), (2 * node + 2, rows[~low], left - 1)]
        return tree

    def of(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), np.int64)
        todo = np.arange(len(x))
        while len(todo):
            d = self.dimension[node[todo]]
            todo, d = todo[d >= 0], d[d >= 0]
            here = node[todo]
            node[todo] = 2 * here + np.where(x[todo, d] <= self.value[here], 1, 2)
        return node


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten()).reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _vectors(df: DataFrame, features, width: int) -> DataFrame:
    """``_x`` cut or filled with 0 to the common width."""
    filled = F.concat(F.coalesce("_x", F.array().cast("array<double>")), F.array_repeat(F.lit(0.0), width))
    return _as_array(df, features).withColumn("_x", F.slice(filled, 1, width))


def _search(queries: DataFrame, training: DataFrame, dealt: DataFrame, k: int, boxes: tuple | None = None) -> DataFrame:
    """(qid, nn, n_distances, others) of every (query, cell): ``queries`` has qid, cell, _x; ``dealt``
    says into how many parts and shares a cell is cut; ``others`` are, if ``boxes`` (low, high, cell) are
    given, the further cells that the neighbours found leave to be searched."""
    q = (queries.join(dealt, "cell").withColumn("share", F.pmod(F.xxhash64("qid"), F.col("shares")).cast("int"))
         .select("cell", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "share", "qid", "_x"))
    t = (training.join(dealt, "cell").withColumn("part", F.pmod(F.xxhash64("row"), F.col("parts")).cast("int"))
         .select("cell", "part", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"), "id", "label", "_x"))
    on = ("cell", "part", "share")

    def run(key, left, right):
        if not left.num_rows or not right.num_rows:
            return pa.table([pa.array([], f) for f in (pa.int64(), neighbours, pa.int64(), pa.list_(pa.int32()))], names=names)
        block = _Block(_matrix(right.column("_x")), right.column("id").to_numpy(), right.column("label").to_numpy(), k)
        x, of = _distinct(_matrix(left.column("_x")))
        at, dist, compared = block.search(x)
        starts, others = np.zeros(len(x) + 1, np.int64), np.zeros(0, np.int32)
        if boxes is not None:
            starts, others = _reached(x, dist[:, -1] if dist.shape[1] == k else np.full(len(x), np.inf), key[0].as_py(), *boxes)
        n, width = len(of), at.shape[1]
        at, dist = at[of], dist[of]
        flat = pa.StructArray.from_arrays([pa.array(dist.ravel()), pa.array(block.ids[at].ravel(), pa.int64()), pa.array(block.labels[at].ravel(), pa.int32())],
                                          ["dist", "tid", "tlabel"])
        nn = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * width, pa.int32()), flat)
        others = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(others, pa.int32())).take(pa.array(of))
        return pa.table([left.column("qid"), nn, pa.array(compared[of], pa.int64()), others], names=names)

    neighbours, names = pa.list_(pa.struct([("dist", pa.float64()), ("tid", pa.int64()), ("tlabel", pa.int32())])), ["qid", "nn", "n_distances", "others"]
    return q.groupBy(*on).cogroup(t.groupBy(*on)).applyInArrow(run, f"{_FOUND}, others array<int>")


def _distinct(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different rows, in their order, and which of them each row is."""
    order = np.lexsort(x.T[::-1])
    new = np.r_[True, (x[order[1:]] != x[order[:-1]]).any(1)]
    of = np.empty(len(x), np.int64)
    of[order] = np.cumsum(new) - 1
    return x[order[new]], of


def _reached(x: np.ndarray, kth: np.ndarray, home: int, low: np.ndarray, high: np.ndarray, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cells other than ``home`` whose box is no farther than the k-th neighbour so far, as (where each row's
    begin, cells). Rows of like reach go together, only into cells that the box of them all comes near to."""
    order, pairs = np.argsort(kth, kind="stable"), []
    for s in range(0, len(x), REACH_ROWS):
        rows = order[s:s + REACH_ROWS]
        part, reach = x[rows], kth[rows] * (1 + 1e-9) + 1e-12  # rounding must not rule out a cell at the very distance
        side = np.maximum(np.maximum(low - part.max(0), part.min(0) - high), 0)
        near = np.flatnonzero((np.sqrt((side**2).sum(1)) <= reach[-1]) & (cells != home))
        for c in range(0, len(near), REACH_CELLS):
            some = near[c:c + REACH_CELLS]
            gap = np.zeros((len(part), len(some)))
            for d in range(x.shape[1]):
                side = np.maximum(np.maximum(low[some, d] - part[:, d, None], part[:, d, None] - high[some, d]), 0)
                gap += side * side
            i, j = np.nonzero(np.sqrt(gap) <= reach[:, None])
            pairs.append((rows[i], cells[some[j]]))
    row, cell = (np.concatenate(v) if pairs else np.zeros(0, np.int64) for v in (list(zip(*pairs)) or ((), ())))
    order = np.argsort(row, kind="stable")
    return np.searchsorted(row[order], np.arange(len(x) + 1)), cell[order]


def _found(train: DataFrame, queries: DataFrame, features: str | Sequence[str], label: str, id_col: str, k: int = KNN_K, cells: int | None = None,
           part_rows: int = PART_ROWS, share_rows: int = SHARE_ROWS) -> tuple[DataFrame, DataFrame | None]:
    """``queries`` with qid, and (qid, nn, n_distances) of those that found something; None without training rows."""
    spark = train.sparkSession
    ship_package(spark)
    rows = materialize(_as_array(train, features).select(F.col(id_col).cast("long").alias("id"), F.col(label).cast("int").alias("label"), "_x",
                                                         F.monotonically_increasing_id().alias("row")).where("id is not null and label is not null"))
    asked = _as_array(queries, features)
    n, width = rows.agg(F.count(F.lit(1)), F.max(F.size("_x"))).first()
    if not n:
        return asked.drop("_x"), None
    width = max(1, width, asked.agg(F.max(F.size("_x"))).first()[0] or 1)
    rows, asked = _vectors(rows.withColumnRenamed("_x", "_v"), "_v", width).drop("_v"), materialize(
        _vectors(asked.withColumnRenamed("_x", "_v"), "_v", width).drop("_v").withColumn("qid", F.monotonically_increasing_id()))
    sample = rows if n <= SAMPLE_ROWS else rows.where(hash_share(F.xxhash64("row"), SAMPLE_ROWS / n))
    cells = max(CELLS, 2 * n // part_rows) if cells is None else cells
    tree = Cells.build(_matrix(sample.select("_x").toArrow().column(0)), cells, 2 * k)

    def with_cell(df):
        schema = StructType([*df.schema.fields, StructField("cell", IntegerType())])
        names = df.columns
        at = names.index("_x")

        def run(batches):
            for b in batches:
                if b.num_rows:
                    yield pa.RecordBatch.from_arrays([*b.columns, pa.array(tree.of(_matrix(b.column(at))), pa.int32())], [*names, "cell"])

        return df.mapInArrow(run, schema)

    training = materialize(with_cell(rows))
    asked_in = materialize(with_cell(asked.select("qid", "_x")))
    # One row per cell: boxes and counts.
    boxes = training.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), *[f(F.col("_x")[i]).alias(f"{f.__name__}{i}") for f in (F.min, F.max) for i in range(width)]).collect()
    boxes = sorted(boxes, key=lambda r: r.cell)
    low = np.array([[r[f"min{i}"] for i in range(width)] for r in boxes])
    high = np.array([[r[f"max{i}"] for i in range(width)] for r in boxes])
    numbers = np.array([r.cell for r in boxes])
    waiting = {r.cell: r["count"] for r in asked_in.groupBy("cell").count().collect()}

    def dealt(asking: dict[int, int]) -> DataFrame:
        return spark.createDataFrame([(r.cell, math.ceil(r.n / part_rows), max(1, math.ceil(asking.get(r.cell, 0) / share_rows))) for r in boxes],
                                     "cell int, parts int, shares int")

    def merged(found: DataFrame) -> DataFrame:
        others = F.array_distinct(F.flatten(F.collect_list("others")))
        nearest = F.slice(F.array_sort(F.flatten(F.collect_list("nn"))), 1, k)  # k long, as each list is a sorted top k
        return found.groupBy("qid").agg(nearest.alias("nn"), F.sum("n_distances").alias("n_distances"), others.alias("others"))

    first = _search(asked_in, training, dealt(waiting), k, (low, high, numbers))
    # Every part of a cell tells which cells its own neighbours leave: no fewer than those of all parts together.
    first = materialize(merged(first) if max(r.n for r in boxes) > part_rows else first)
    again = materialize(first.where(F.size("others") > 0).join(asked_in.drop("cell"), "qid").select("qid", "_x", F.explode("others").alias("cell")))
    waiting = {r.cell: r["count"] for r in again.groupBy("cell").count().collect()}
    found = first
    if waiting:
        both = first.where(F.size("others") > 0).unionByName(_search(again, training, dealt(waiting), k))
        found = first.where(F.size("others") == 0).unionByName(merged(both))
    return asked.drop("_x"), found.drop("others")


def nearest(train: DataFrame, queries: DataFrame, features: str | Sequence[str], label: str, id_col: str, k: int = KNN_K, cells: int | None = None,
            part_rows: int = PART_ROWS, share_rows: int = SHARE_ROWS) -> DataFrame:
    """``queries`` with _nn (dist, tid, tlabel of the k nearest, nearest first) and n_distances,
    the number of training rows it was compared with. ``cells``: default ``CELLS``, or what
    keeps a cell near half of ``part_rows``."""
    asked, found = _found(train, queries, features, label, id_col, k, cells, part_rows, share_rows)
    if found is None:
        return asked.withColumn("_nn", F.array().cast(_FOUND.split("nn ")[1].split(", n_d")[0])).withColumn("n_distances", F.lit(0).cast("long"))
    return asked.join(found, "qid", "left").drop("qid").withColumnRenamed("nn", "_nn")


def votes(dist: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """``vote`` of rows of neighbours, nearest first; an infinite distance is none."""
    there, zero = np.isfinite(dist), dist == 0
    with np.errstate(divide="ignore"):
        weight = np.where(zero.any(1)[:, None], zero.astype(float), np.where(there, 1.0 / dist, 0.0))
    sums = np.zeros(dist.shape)
    for j in range(dist.shape[1]):
        sums += np.where(labels[:, j, None] == labels, weight[:, j, None], 0.0)
    sums[~there] = -1
    return np.where(sums == sums.max(1, keepdims=True), labels, np.iinfo(labels.dtype).max).min(1)


def knn_classify(train: DataFrame, queries: DataFrame, features: str | Sequence[str], label: str, id_col: str, k: int = KNN_K,
                 prediction: str = "prediction", **options) -> DataFrame:
    """Append n_distances and the class of the inverse-distance vote to every query row."""
    asked, found = _found(train, queries, features, label, id_col, k, **options)
    if found is None:
        return asked.withColumns({"n_distances": F.lit(0).cast("long"), prediction: F.lit(None).cast("int")}).drop("qid")

    def run(batches):
        for b in batches:
            nn = b.column(1)
            n, lengths = len(nn), nn.value_lengths().to_numpy()
            row, place = np.repeat(np.arange(n), lengths), np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            dist, labels = np.full((n, k), np.inf), np.zeros((n, k), np.int32)
            flat = nn.flatten()
            dist[row, place], labels[row, place] = flat.field("dist").to_numpy(), flat.field("tlabel").to_numpy()
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(votes(dist, labels), mask=lengths == 0)], ["qid", "n_distances", prediction])

    schema = StructType([StructField("qid", LongType()), StructField("n_distances", LongType()), StructField(prediction, IntegerType())])
    return asked.join(found.mapInArrow(run, schema), "qid", "left").drop("qid")
