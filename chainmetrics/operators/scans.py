"""Running sums and moving means over series too long for one task (E1, E2, E4 at row grain).

A series is cut into blocks that follow its order. Sums run inside a block, and every
block starts from the total of those before it; a moving mean borrows the last rows of the
block before (its halo). No task sees more than a block, and only block totals, one row
per block, are brought together.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chainmetrics.session import materialize

BLOCKS = 64
#: Rows of a block of moving means (at least the widest window).
BLOCK_ROWS = 100_000


def bounds(df: DataFrame, columns: Sequence[Column], blocks: int = BLOCKS) -> list[list[float]]:
    """About equally spaced quantiles of each column (sketched; they only set block sizes):
    at most ``blocks`` - 1 numbers for each."""
    share = [j / blocks for j in range(1, blocks)]
    got = df.agg(*[F.percentile_approx(c.cast("double"), share, 10_000).alias(f"b{i}") for i, c in enumerate(columns)]).first()
    return [sorted(set(b)) if b else [] for b in got]


def block_of(value: Column, edges: Sequence[float] | Column) -> Column:
    """Number of edges below the value: blocks follow the values, equal values share one."""
    edges = F.array(*[F.lit(float(e)) for e in edges]) if not isinstance(edges, Column) else edges
    edges = edges.cast("array<double>")
    return F.size(F.filter(edges, lambda e: e < value.cast("double")))


def running_sums(df: DataFrame, order: Sequence[str], sums: Mapping[str, Column], block: str, by: Sequence[str] = (),
                 following: Mapping[str, str] | None = None) -> DataFrame:
    """Append the running sums ``{name: column}`` over ``order`` within ``by``, the current row included.

    ``block`` is a column (int, from 0) that rises with ``order``; ``order`` is unique within
    ``by``. ``following`` ({name: column}) appends the next row's value of a column,
    across blocks; the column is one of ``order`` and rises."""
    following = dict(following or {})
    inside = Window.partitionBy(*by, block).orderBy(*order)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = df.groupBy(*by, block).agg(*[F.sum(c).alias(f"_t_{n}") for n, c in sums.items()], *[F.min(c).alias(f"_m_{n}") for n, c in following.items()])
    if by:
        before = Window.partitionBy(*by).orderBy(block)
        firsts = totals.select(*[F.col(c).alias(f"_k_{c}") for c in (*by, block)],
                               *[F.coalesce(F.sum(f"_t_{n}").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(f"_f_{n}") for n in sums],
                               *[F.lead(f"_m_{n}").over(before).alias(f"_n_{n}") for n in following])
        same = [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in (*by, block)]
        out = df.join(firsts, same)
        offset = {n: F.col(f"_f_{n}") for n in sums}
        later = {n: F.col(f"_n_{n}") for n in following}
    else:
        # One series: at most as many totals as there are blocks, kept as constants of the plan.
        rows = {r[block]: r for r in totals.collect()}
        size = max(rows, default=-1) + 1
        start, offset, later = dict.fromkeys(sums, 0), {}, {}
        starts = {n: [] for n in sums}
        for b in range(size):
            for n in sums:
                starts[n].append(start[n])
                start[n] += (rows[b][f"_t_{n}"] or 0) if b in rows else 0
        for n in sums:
            offset[n] = F.get(F.array(*[F.lit(v) for v in starts[n]]), F.col(block)) if size else F.lit(0)
        for n in following:
            nexts, value = [], None
            for b in reversed(range(size)):
                nexts.append(value)
                value = rows[b][f"_m_{n}"] if b in rows else value
            later[n] = F.get(F.array(*[F.lit(v) for v in reversed(nexts)]), F.col(block)) if size else F.lit(None)
        out = df
    for n, c in sums.items():
        out = out.withColumn(n, F.coalesce(F.sum(c).over(upto), F.lit(0)) + offset[n])
    for n, c in following.items():
        out = out.withColumn(n, F.coalesce(F.lead(c).over(inside), later[n]))
    return out.select(*df.columns, *sums, *following)


def long_running_sums(df: DataFrame, order: Sequence[str], columns: Mapping[str, str], blocks: int = BLOCKS) -> DataFrame:
    """Running sums ``{name: column}`` of a whole table in the order of ``order`` (unique together);
    blocks are ranges of its first column (a date, a timestamp or a number, not null)."""
    rows = materialize(df)
    at = _number(rows, order[0])
    edges = bounds(rows, [at], blocks)[0]
    out = running_sums(rows.withColumn("_block", block_of(at, edges)), order, {n: F.col(c) for n, c in columns.items()}, "_block")
    return out.drop("_block")


def _number(df: DataFrame, column: str) -> Column:
    kind = df.schema[column].dataType.typeName()
    if kind == "date":
        return F.unix_date(column).cast("double")
    if kind.startswith("timestamp"):
        return F.unix_micros(F.col(column).cast("timestamp")).cast("double")
    return F.col(column).cast("double")


def moving_means(df: DataFrame, order: Sequence[str], column: str, windows: Sequence[int], blocks: int = BLOCKS,
                 block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Append d<w>, the mean of ``column`` over the last w rows, for every w; null until w rows are there.

    Rows are numbered (a running count), dealt to blocks of ``block_rows`` numbers, and a
    block also gets the max(windows) - 1 rows before it."""
    halo = max(windows) - 1
    size = max(block_rows, halo + 1)
    rows = materialize(df)
    at = _number(rows, order[0])
    numbered = running_sums(rows.withColumn("_block", block_of(at, bounds(rows, [at], blocks)[0])), order, {"_row": F.lit(1)}, "_block")
    block = F.floor((F.col("_row") - 1) / size)
    also = F.when((F.col("_row") - 1) % size >= size - halo, F.array(block, block + 1)).otherwise(F.array(block))
    dealt = numbered.withColumn("_block", F.explode(also))
    inside = Window.partitionBy("_block").orderBy("_row")
    out = dealt
    for w in windows:
        out = out.withColumn(f"d{w}", F.when(F.col("_row") >= w, F.avg(column).over(inside.rowsBetween(-(w - 1), Window.currentRow))))
    return out.where(F.col("_block") == block).select(*df.columns, *[f"d{w}" for w in windows])
