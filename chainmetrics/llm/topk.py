"""Exact top-k search by inner product: columnar branch-and-bound.

Vectors are held dimension by dimension (vertical layout), dimensions in falling order
of the queries' mass. The scores of all candidates of a batch grow dimension block by
dimension block; after each block a candidate can gain at most
``|rest of query| * |rest of candidate|`` (Cauchy-Schwarz), and those whose bound stays
below the query's k-th best score so far are dropped and the survivors compacted.

The queries are a stated set, taken in blocks of ``QUERY_BLOCK``; a block is collected
and broadcast (its size is proven: at most that many vectors), and one row-local pass
over all vectors keeps each task's k best per query. A window then takes the k best of
the tasks' winners. Nothing is sampled, and no candidate is dropped unless k others
are proven to score higher.

Components are the integers ``floor(scale * x)``, scores their inner products. Where
all sums stay below 2**53 they are held as doubles (exact); larger ones are computed
in Python integers, and scores beyond a long saturate.

Defined results: vectors that are null or hold null or non-finite components take no
part, on either side; vectors of another length than the query score only over the
common dimensions (missing ones count 0); ties go to the smaller id; a query never
meets rows of its own id; query rows of one id answer once, by the least of their
vectors; repeated candidates are candidates each; fewer than k candidates give fewer
rows; a null id takes no part; empty tables give an empty table; extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window

from chainmetrics.llm import textbuf as tb

QUERY_BLOCK = 4096
DIM_BLOCK = 16
SCALE = 1024
#: Candidates scored together; the first ones set the thresholds for the rest.
BATCH = 4096
QUERY_STEP = 256
LEAST = np.iinfo(np.int64).min


def matrix(column: pa.Array, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows that take part, their integer components as rows x dimensions)."""
    column = column.cast(pa.list_(pa.float64()))
    lens = np.nan_to_num(column.value_lengths().to_numpy(zero_copy_only=False), nan=-1).astype(np.int64)
    ok = lens >= 0
    flat = column.flatten()
    values = flat.to_numpy(zero_copy_only=False).astype(np.float64)  # null components become nan
    rows = np.repeat(np.arange(len(lens)), np.maximum(lens, 0))
    bad = np.unique(rows[~np.isfinite(values)])
    ok[bad] = False
    width = int(lens.max()) if len(lens) else 0
    out = np.zeros((len(lens), max(width, 0)))
    at = tb.ragged(np.zeros(len(lens), np.int64), np.maximum(lens, 0))
    out[rows, at] = values
    out[~ok] = 0
    return np.flatnonzero(ok), np.floor(out[ok] * scale)


def _whole(column: pa.ChunkedArray) -> pa.Array:
    out = column.combine_chunks()
    return out.chunk(0) if isinstance(out, pa.ChunkedArray) else out


class Queries:
    """One block of queries in vertical layout, with the mass of what remains after each block."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, k: int, scale: int):
        self.ids, self.k, self.scale = ids, k, scale
        self.order = np.argsort(-(rows**2).sum(0), kind="stable")
        self.rows = rows[:, self.order]
        self.cuts = [*range(0, rows.shape[1], DIM_BLOCK), rows.shape[1]] if rows.shape[1] else [0, 0]
        self.rest = self.remaining(self.rows)

    def remaining(self, rows: np.ndarray) -> np.ndarray:
        """Norm of the dimensions from each cut on."""
        mass = np.array([(rows[:, c:] ** 2).sum(1) for c in self.cuts])
        return np.sqrt(mass)

    def candidates(self, rows: np.ndarray) -> np.ndarray:
        """Candidates' components in the queries' dimensions and order."""
        width = self.rows.shape[1]
        full = np.zeros((len(rows), width))
        full[:, :min(width, rows.shape[1])] = rows[:, :width]
        return full[:, self.order]

    def start(self):
        n = len(self.ids)
        return np.full((n, self.k), LEAST), np.full((n, self.k), np.iinfo(np.int64).max)

    def update(self, best: tuple[np.ndarray, np.ndarray], ids: np.ndarray, rows: np.ndarray) -> None:
        """Take a batch of candidates into ``best`` = (scores, ids), each query's in rank order."""
        if not len(self.ids):
            return
        x = self.candidates(rows)
        peak = np.abs(x).max(initial=0) * np.abs(self.rows).max(initial=0) * max(1, x.shape[1])
        if peak >= 2**53:
            return self._update_large(best, ids, x)
        vertical = np.ascontiguousarray(x.T)
        rest = self.remaining(x)
        slack = 1e-9 * peak + 1  # rounding of the bounds; the scores themselves are exact
        lo, hi = 0, self.cuts[1] if len(self.cuts) > 1 else 0
        for q0 in range(0, len(self.ids), QUERY_STEP):
            # The first block of dimensions for many queries at once.
            part = self.rows[q0:q0 + QUERY_STEP, lo:hi] @ vertical[lo:hi]
            for q in range(q0, min(q0 + QUERY_STEP, len(self.ids))):
                worst, total = best[0][q, -1], part[q - q0]
                left = np.flatnonzero((total + self.rest[1, q] * rest[1] + slack >= worst) & (ids != self.ids[q]))
                total = total[left]
                for b in range(1, len(self.cuts) - 1):
                    if not len(left):
                        break
                    c, d = self.cuts[b], self.cuts[b + 1]
                    total = total + self.rows[q, c:d] @ vertical[c:d, left]
                    keep = total + self.rest[b + 1, q] * rest[b + 1, left] + slack >= worst
                    left, total = left[keep], total[keep]
                if len(left):
                    self._merge(best, q, ids[left], total.astype(np.int64))

    def _merge(self, best, q: int, ids: np.ndarray, scores: np.ndarray) -> None:
        s, i = np.concatenate((best[0][q], scores)), np.concatenate((best[1][q], ids))
        top = np.lexsort((i, ~s))[:self.k]  # ~s falls as s grows, without overflow
        best[0][q], best[1][q] = s[top], i[top]

    def _update_large(self, best, ids: np.ndarray, x: np.ndarray) -> None:
        """The same without bounds in Python integers, for components too large for doubles."""
        for q in range(len(self.ids)):
            query = [int(v) for v in self.rows[q]]
            other = np.flatnonzero(ids != self.ids[q])
            total = [sum(a * int(v) for a, v in zip(query, x[c])) for c in other]
            self._merge(best, q, ids[other], np.array([min(max(t, LEAST + 1), 2**63 - 1) for t in total], np.int64))


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
          scale: int = SCALE, query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best other rows of every query row."""
    spark = vectors.sparkSession
    tb.bounded_batches(spark)
    schema = T.StructType([T.StructField("query_id", T.LongType()), T.StructField("vec_id", T.LongType()), T.StructField("score", T.LongType())])
    arrow = to_arrow_schema(schema)
    base = (vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"), is_query.alias("q"))
            .where("id is not null and v is not null")
            # Vectors with a null or non-finite component are no rows of the search, before any choice among equal ids.
            .where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))))
    queries = base.where("q").groupBy("id").agg(F.min("v").alias("v"))
    blocks = max(1, math.ceil(queries.count() / query_block))
    out = None
    for block in range(blocks):
        got = queries.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == block).toArrow()
        ok, rows = matrix(_whole(got.column("v")), scale) if got.num_rows else (np.zeros(0, np.int64), np.zeros((0, 0)))
        ids, first = np.unique(got.column("id").to_numpy()[ok], return_index=True)
        shared = spark.sparkContext.broadcast(Queries(ids, rows[first], k, scale))

        def run(batches, shared=shared):
            q = shared.value
            best = q.start()
            for batch in batches:
                ok, rows = matrix(batch.column(1), q.scale)
                ids = batch.column(0).to_numpy(zero_copy_only=False)[ok]
                for i in range(0, len(ids), BATCH):
                    q.update(best, ids[i:i + BATCH], rows[i:i + BATCH])
            scores, found = best
            at, rank = np.nonzero(found < np.iinfo(np.int64).max)
            yield pa.RecordBatch.from_arrays([pa.array(q.ids[at], pa.int64()), pa.array(found[at, rank], pa.int64()),
                                              pa.array(scores[at, rank], pa.int64())], schema=arrow)

        part = base.select("id", "v").mapInArrow(run, schema)
        out = part if out is None else out.unionByName(part)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return (out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int"), "vec_id", "score"))
