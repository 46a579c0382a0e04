"""Decision tree with exact entropy splits and no depth limit.

Rows are kept in blocks of values and of codes, the numbers of their quantiles. Large nodes are split level by level
on Spark, in two passes over the blocks, which stay where they are; rows are led through the few nodes
made so far, and after some levels those of large nodes are stored anew. The first pass counts classes by (node,
feature, bin); bins follow the values' quantiles. Their edges are candidates with exact gains.
The gain is convex in the class counts to the left, so no threshold inside a bin gains
more than the corners of what the bin can add: bins that can't reach the best edge of their
node are done. The second pass tries every value of the other bins. So the split is
the best of all thresholds, not of bins; bins only save work. A node of at most ``local_rows`` rows
is finished by one task, with the same rule, to any depth; such groups are bounded by that count.

Rule: the threshold halves the gap between two neighbouring values, rows up to it go left; the
largest gain wins, in billionths, ties go to the smaller feature, then threshold. A node
is a leaf if it is pure or all its rows are equal. Its prediction is its most frequent class
(ties to the smaller). Null and NaN features count as 0.

The tree is a table: ``root`` names a distributed node ("" is the top, then 0 for left and 1
for right), ``node`` numbers the nodes of a subtree that was finished locally (0: its top);
inner nodes have feature, threshold, gain, left and right (local numbers; -1: the
distributed nodes root + "0" and root + "1"), all have n and prediction.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import IntegerType, StructField, StructType

from chainmetrics.operators.binary_boosting import row_function
from chainmetrics.session import materialize, ship_package

LOCAL_ROWS = 200_000
#: Bins of a feature in the largest nodes.
BINS = 8_192
#: With up to so many classes, the corners of a bin (2 ** classes) bound its gains.
CORNER_CLASSES = 5
#: Billionths by which a bound may be too small by rounding.
SLACK = 2
#: Rows of the cells that one task searches, about.
GROUP_ROWS = 500_000
#: Rows are led through so many levels before those of the large nodes are stored anew.
ROUTE_LEVELS = 8
BLOCK_ROWS = 65_536
#: A tree of at most so many nodes is broadcast for predictions.
BROADCAST_NODES = 1_000_000
#: Rows of a finished subtree that one task predicts, about.
SHARE_ROWS = 200_000
TREE = "root string, node int, feature int, threshold double, gain double, left int, right int, n long, prediction int"
UNITS = 1e9


def numbers(features: Sequence[str]) -> list[Column]:
    return [F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0)) for c in features]


def vector(features: Sequence[str]) -> Column:
    return F.array(*numbers(features))


# -- local part ------------------------------------------------------------------

def _entropy(counts: np.ndarray) -> np.ndarray:
    share = counts / counts.sum(-1, keepdims=True)
    return -(share * np.log2(np.where(share > 0, share, 1))).sum(-1)


class _Level:
    """Rows of one level's open nodes, for every feature in the order (node, value)."""

    def __init__(self, x: np.ndarray, y: np.ndarray, classes: int):
        self.x, self.y, self.classes = x, y, classes
        self.orders = [np.argsort(x[:, f], kind="stable") for f in range(x.shape[1])]
        self.node = np.zeros(len(y), np.int64)
        self.counts = np.bincount(y, minlength=classes)[None].astype(float)

    def splits(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(gain in billionths, feature, threshold) of the best split of every node; feature -1: all its rows are equal."""
        sizes = self.counts.sum(1)
        first = (np.cumsum(sizes) - sizes).astype(np.int64)
        units, feature, threshold = np.full(len(sizes), -1.0), np.full(len(sizes), -1, np.int64), np.zeros(len(sizes))
        whole = _entropy(self.counts)
        owner = np.repeat(np.arange(len(sizes)), sizes.astype(np.int64))  # the same for every feature
        before = np.cumsum(self.counts, axis=0) - self.counts
        for f, order in enumerate(self.orders):
            v, y = self.x[order, f], self.y[order]
            at = np.flatnonzero((v[1:] > v[:-1]) & (owner[1:] == owner[:-1]))
            if not len(at):
                continue
            node = owner[at]
            left = np.stack([np.cumsum(y == k)[at] for k in range(self.classes)], 1) - before[node]
            n, size = sizes[node], (at - first[node] + 1).astype(float)
            gain = whole[node] - size / n * _entropy(left) - (n - size) / n * _entropy(self.counts[node] - left)
            gain = np.floor(gain * UNITS + 0.5)
            begins = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
            most = np.repeat(np.maximum.reduceat(gain, begins), np.diff(np.r_[begins, len(node)]))
            top = np.flatnonzero(gain == most)
            top = top[np.r_[True, node[top][1:] != node[top][:-1]]]  # the first of equal ones: the smaller threshold
            top = top[gain[top] > units[node[top]]]
            won, a, b = node[top], v[at[top]], v[at[top] + 1]
            middle = a + (b - a) / 2
            units[won], feature[won], threshold[won] = gain[top], f, np.where(middle < b, middle, a)
        return units, feature, threshold

    def descend(self, feature: np.ndarray, threshold: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Go on with the impure children of split nodes: (class counts of all children, two for
        each split node, and which of them are open)."""
        rank = np.cumsum(feature >= 0) - 1
        rows = self.orders[0][feature[self.node[self.orders[0]]] >= 0]
        at = self.node[rows]
        right = ~(self.x[rows, feature[at]] <= threshold[at])
        child = 2 * rank[at] + right
        m = 2 * int((feature >= 0).sum())
        counts = np.bincount(child * self.classes + self.y[rows], minlength=m * self.classes).reshape(m, self.classes).astype(float)
        open_ = np.count_nonzero(counts, axis=1) > 1
        number = np.where(open_, np.cumsum(open_) - 1, -1)
        self.node[:] = -1
        self.node[rows] = number[child]
        is_right = np.zeros(len(self.y), bool)
        is_right[rows] = right
        # Rows stay in order: those of a left child move up past the right ones of their parent.
        self.counts = counts[open_]
        sizes = self.counts.sum(1).astype(np.int64)
        rights = np.where(np.flatnonzero(open_) % 2 == 1, sizes, 0)
        start = np.cumsum(sizes) - sizes
        parent = np.flatnonzero(open_) // 2
        begins = np.r_[True, parent[1:] != parent[:-1]] if len(parent) else np.zeros(0, bool)
        earlier = (np.cumsum(rights) - rights)[np.maximum.accumulate(np.where(begins, np.arange(len(parent)), 0))]
        for f, order in enumerate(self.orders):
            kept = order[self.node[order] >= 0]
            side, number = is_right[kept], self.node[kept]
            passed = np.cumsum(side) - side - earlier[number]
            moved = np.empty_like(kept)
            moved[np.where(side, start[number] + passed, np.arange(len(kept)) - passed)] = kept
            self.orders[f] = moved
        return counts, open_


def grow(x: np.ndarray, y: np.ndarray, classes: int) -> list[np.ndarray]:
    """Columns node, feature (-1: leaf), threshold, gain, left, right, n, prediction of a whole
    subtree, all nodes of a level at once."""
    level, numbers = _Level(x, y, classes), np.zeros(1, np.int64)
    tops = level.counts
    out, made = [], 1
    if np.count_nonzero(tops) <= 1:
        return [np.array([v]) for v in (0, -1, 0.0, 0.0, -1, -1, len(y), int(tops[0].argmax()))]
    while len(numbers):
        counts = level.counts
        units, feature, threshold = level.splits()
        split = feature >= 0
        left = np.where(split, made + 2 * (np.cumsum(split) - 1), -1)
        out.append((numbers, feature, threshold, np.where(split, units / UNITS, 0.0), left, np.where(split, left + 1, -1), counts.sum(1), counts.argmax(1)))
        below, open_ = level.descend(feature, threshold)
        children = made + np.arange(len(below))
        made += len(below)
        pure, none = below[~open_], np.full(int((~open_).sum()), -1)
        out.append((children[~open_], none, none * 0.0, none * 0.0, none, none, pure.sum(1), pure.argmax(1)))
        numbers = children[open_]
    return [np.concatenate(c) for c in zip(*out)]


def dealt(sizes: dict[int, int], parts: int) -> dict[int, int]:
    """A part for every node: the largest nodes first, each to the part with the fewest rows."""
    heap, out = [(0, p) for p in range(parts)], {}
    for node in sorted(sizes, key=sizes.get, reverse=True):
        rows, p = heapq.heappop(heap)
        out[node] = p
        heapq.heappush(heap, (rows + sizes[node], p))
    return out


def finished(spark, blocks: RDD, ends, sizes: dict[int, int], roots: list[str], parts: int, grown) -> DataFrame:
    """The tree table of whole subtrees: rows of the nodes in ``sizes`` meet in one task each, which gets
    ``grown(node, arrays)``. ``ends`` leads a block to (node of every row, arrays with rows last)."""
    local, part_of = np.zeros(len(roots), bool), dealt(sizes, parts)
    local[list(sizes)] = True

    def chunks(block):
        at, arrays = ends(block)
        rows = np.flatnonzero(local[at])
        rows = rows[np.argsort(at[rows], kind="stable")]
        for some in np.split(rows, np.flatnonzero(np.diff(at[rows])) + 1) if len(rows) else ():
            yield int(at[some[0]]), [np.ascontiguousarray(a[..., some]) for a in arrays]

    def finish(part):
        held: dict[int, list] = {}
        for node, chunk in part:
            held.setdefault(node, []).append(chunk)
        while held:
            node, found = held.popitem()
            yield roots[node], pickle.dumps(grown(node, [np.concatenate(c, axis=-1) for c in zip(*found)]))

    packed = blocks.flatMap(chunks).partitionBy(parts, part_of.__getitem__).mapPartitions(finish)
    return spark.createDataFrame(packed, "root string, packed binary", verifySchema=False).mapInArrow(_unpack, TREE)


def _unpack(batches):
    kinds = [pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.int32(), pa.int32(), pa.int64(), pa.int32()]
    names = ["node", "feature", "threshold", "gain", "left", "right", "n", "prediction"]
    for batch in batches:
        for root, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            grown = pickle.loads(packed)
            for s in range(0, len(grown[0]), 100_000):
                part = [c[s:s + 100_000] for c in grown]
                leaf = part[1] < 0
                columns = [pa.array(c.astype(k.to_pandas_dtype()), k, mask=leaf if 0 < i < 6 else None) for i, (c, k) in enumerate(zip(part, kinds))]
                yield pa.RecordBatch.from_arrays([pa.array([root] * len(leaf), pa.string()), *columns], names=["root", *names])


# -- distributed part --------------------------------------------------------------

def _values(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten()).reshape(len(column), -1)


class _Top:
    """The distributed nodes made so far; a child of -1 is not made yet (the node is a leaf or open)."""

    def __init__(self):
        self.root, self.feature, self.threshold, self.left, self.right = [""], [-1], [0.0], [-1], [-1]

    def split(self, node: int, feature: int, threshold: float) -> tuple[int, int]:
        made = len(self.root)
        self.feature[node], self.threshold[node], self.left[node], self.right[node] = feature, threshold, made, made + 1
        for side in "01":
            self.root.append(self.root[node] + side)
            self.feature.append(-1)
            self.threshold.append(0.0)
            self.left.append(-1)
            self.right.append(-1)
        return made, made + 1

    def router(self):
        feature, left, right = (np.array(v, np.int64) for v in (self.feature, self.left, self.right))
        threshold = np.array(self.threshold)

        def route(x: np.ndarray, at: np.ndarray) -> np.ndarray:
            """Where rows (features x rows) that have come to ``at`` end."""
            at = at.astype(np.int64)
            todo = np.flatnonzero(feature[at] >= 0)
            while len(todo):
                here = at[todo]
                at[todo] = np.where(x[feature[here], todo] <= threshold[here], left[here], right[here])
                todo = todo[feature[at[todo]] >= 0]
            return at

        return route


def _gains(left: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Gain in billionths of splits with these class counts to the left; 0 if a side is empty."""
    n, size = counts.sum(), left.sum(-1)
    one = size[..., None] * 0 + 1
    inside = (size > 0) & (size < n)
    safe = np.where(inside[..., None], left, one)
    other = np.where(inside[..., None], counts - left, one)
    gain = _entropy(counts) - size / n * _entropy(safe) - (n - size) / n * _entropy(other)
    return np.where(inside, np.floor(gain * UNITS + 0.5), 0)


def _edges(rows: DataFrame, width: int, bins: int) -> list[np.ndarray]:
    """About equally spaced quantiles of every feature (sketched; they only set the sizes of bins)."""
    # One text literal: thousands of numbers for each feature would take the analyser long.
    share = F.split(F.lit(",".join(str(j / bins) for j in range(1, bins))), ",").cast("array<double>")
    got = rows.agg(*[F.percentile_approx(F.col("x")[i], share, 10_000) for i in range(width)]).first()
    return [np.unique(e if e else []).astype(float) for e in got]


def _bins_of(n: int, most: int) -> int:
    """Every how manieth edge a node of n rows uses: about 2 sqrt(n) bins leave few to search."""
    step = 1
    while most / step > max(16, 3 * n**0.5):
        step *= 2
    return step


def _blocks(rows: DataFrame, edges: list[np.ndarray]) -> RDD:
    """Blocks of (codes, values, classes, nodes) of the rows (y, x), features first; a value's code is how many edges lie below."""

    def pack(batches):
        held, size = [], 0
        for b in batches:
            if b.num_rows:
                held.append((b.column(0).to_numpy().astype(np.int16), _values(b.column(1))))
                size += b.num_rows
            if size >= BLOCK_ROWS:
                yield block(held)
                held, size = [], 0
        if size:
            yield block(held)

    def block(held):
        y, x = np.concatenate([h[0] for h in held]), np.ascontiguousarray(np.concatenate([h[1] for h in held]).T)
        codes = np.stack([np.searchsorted(e, v, side="left").astype(np.uint16) for e, v in zip(edges, x)])
        return pa.RecordBatch.from_arrays([pa.array([c.tobytes()], pa.binary()) for c in (codes, x, y)], ["codes", "x", "y"])

    def arrays(r):
        y = np.frombuffer(r.y, np.int16)
        return np.frombuffer(r.codes, np.uint16).reshape(-1, len(y)), np.frombuffer(r.x).reshape(-1, len(y)), y, np.zeros(len(y), np.int32)

    return rows.mapInArrow(pack, "codes binary, x binary, y binary").rdd.map(arrays).coalesce(rows.sparkSession.sparkContext.defaultParallelism)


def _extremes(blocks: RDD, width: int, codes: int) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest value of every (feature, code)."""

    def run(part):
        low, high = np.full((width, codes), np.inf), np.full((width, codes), -np.inf)
        for code, x, _, _ in part:
            for f in range(width):
                order = np.argsort(x[f], kind="stable")  # codes rise with the values
                c, v = code[f][order], x[f][order]
                first = np.flatnonzero(np.r_[True, c[1:] != c[:-1]])
                low[f, c[first]] = np.minimum(low[f, c[first]], v[first])
                last = np.r_[first[1:], len(c)] - 1
                high[f, c[last]] = np.maximum(high[f, c[last]], v[last])
        yield low, high

    return blocks.mapPartitions(run).reduce(lambda a, b: (np.minimum(a[0], b[0]), np.maximum(a[1], b[1])))


def _splits(blocks: RDD, top: _Top, open_: dict[int, np.ndarray], classes: int, most: int, low: np.ndarray, high: np.ndarray) -> dict[int, tuple]:
    """{node: (units, feature, threshold, class counts to the left)} of the best split of every
    open node ({node: class counts}); nodes of equal rows have none."""
    nodes, width, route = sorted(open_), len(low), top.router()
    sizes = [open_[v].astype(float) for v in nodes]
    place = np.full(len(top.root), -1)
    place[nodes] = np.arange(len(nodes))
    step = np.array([_bins_of(int(n.sum()), most) for n in sizes])
    bins = (most - 1) // step + 1
    begins = np.cumsum(bins) - bins
    size = int(bins.sum())

    def mine(part):
        """Slots of the rows of open nodes, their cells (features x rows; slot, then bin), values and classes."""
        for code, x, y, at in part:
            slot = place[route(x, at)]
            rows = np.flatnonzero(slot >= 0)
            if len(rows) < len(slot):
                code, x, y, slot = code.take(rows, axis=1), x.take(rows, axis=1), y[rows], slot[rows]
            if len(rows):
                yield slot, begins[slot] + code // step[slot], x, y

    def histogram(part):
        n = np.zeros((width, size * classes), np.int64)
        for _, cells, _, y in mine(part):
            for f in range(width):
                n[f] += np.bincount(cells[f] * classes + y, minlength=size * classes)
        for s, (b, k) in enumerate(zip(begins, bins)):
            for f in range(width):
                yield (s, f), n[f, b * classes:(b + k) * classes]

    def edge_and_bounds(found):
        """The best edge (slot, feature, units, its bin, the next one, counts to its left), and the bins that may hold
        better thresholds: (slot, feature, bound, bin, -1, counts before it, rows)."""
        (slot, feature), n = found
        n = n.reshape(-1, classes)
        there = np.flatnonzero(n.any(1))
        n, upto, out, least = n[there], np.cumsum(n[there], axis=0), [], -1.0
        if len(there) > 1:
            units = _gains(upto[:-1], sizes[slot])
            b, least = int(units.argmax()), float(units.max())
            out.append((slot, feature, least, int(there[b]), int(there[b + 1]), upto[b], 0))
        bound = np.full(len(there), np.inf)
        if classes <= CORNER_CLASSES:
            bound = np.max([_gains(upto - n + n * [c >> k & 1 for k in range(classes)], sizes[slot]) for c in range(1 << classes)], axis=0)
        codes = there * step[slot]
        of = lambda f, v: f.reduceat(v[feature], np.arange(0, most, step[slot]))[there]
        different = of(np.maximum, high) > of(np.minimum, low) if len(codes) else np.zeros(0, bool)
        for b in np.flatnonzero(different & (n.sum(1) > 1) & (bound + SLACK >= least)):
            out.append((slot, feature, float(bound[b]), int(there[b]), -1, (upto - n)[b], int(n[b].sum())))
        return out

    parts = blocks.getNumPartitions()
    found = blocks.mapPartitions(histogram).reduceByKey(np.add, parts).flatMap(edge_and_bounds).collect()
    edge: dict[int, tuple] = {}
    for r in found:
        if r[4] >= 0 and (r[0] not in edge or (r[2], -r[1]) > (edge[r[0]][2], -edge[r[0]][1])):
            edge[r[0]] = r
    alive = sorted((int(r[1] * size + begins[r[0]] + r[3]), r) for r in found if r[4] < 0 and (r[0] not in edge or r[2] + SLACK >= edge[r[0]][2]))
    searched, before = np.array([c for c, _ in alive], np.int64), np.array([r[5] for _, r in alive], np.int64).reshape(-1, classes)
    # The cells to be searched are dealt to groups of about GROUP_ROWS rows.
    groups = int(min(max(len(alive), 1), 1 + sum(r[6] for _, r in alive) // GROUP_ROWS))
    won = [(s, r[1], int(begins[s] + r[3]), int(begins[s] + r[4])) for s, r in edge.items()]
    shared = blocks.context.broadcast((searched, before))

    def values(part):
        """(group, (place in ``searched``, value, class counts)), and under the last number the values beside the best edges."""
        searched, _ = shared.value
        held = [[] for _ in range(width)]
        beside = np.array([[-np.inf, np.inf]] * len(won)).reshape(-1, 2)
        for slot, cells, x, y in mine(part):
            for j, (_, f, a, b) in enumerate(won):
                here = x[f][cells[f] == a], x[f][cells[f] == b]
                beside[j] = here[0].max(initial=beside[j, 0]), here[1].min(initial=beside[j, 1])
            for f in range(width):
                if not len(searched):
                    continue
                cell = cells[f] + f * size
                i = np.minimum(np.searchsorted(searched, cell), len(searched) - 1)
                keep = np.flatnonzero(searched[i] == cell)
                if len(keep):
                    held[f].append(_summed(i[keep], x[f][keep], np.eye(classes, dtype=np.int64)[y[keep]]))
        for chunks in held:
            if chunks:
                i, v, n = _summed(*(np.concatenate(c) for c in zip(*chunks)))
                for g in range(groups):
                    some = i % groups == g
                    if some.any():
                        yield g, (i[some], v[some], n[some])
        yield groups, beside

    def search(part):
        """The best threshold of every node among the values of some cells, or the values beside the edges."""
        searched, before = shared.value
        held: dict[int, list] = {}
        for g, chunk in part:
            held.setdefault(g, []).append(chunk)
        for g, chunks in held.items():
            if g == groups:
                yield None, np.stack([np.max([c[:, 0] for c in chunks], axis=0), np.min([c[:, 1] for c in chunks], axis=0)], 1)
                continue
            i, v, n = _summed(*(np.concatenate(c) for c in zip(*chunks)))
            upto = np.cumsum(n, axis=0)
            cell_first = np.flatnonzero(np.r_[True, i[1:] != i[:-1]])
            upto = upto - np.repeat((upto - n)[cell_first], np.diff(np.r_[cell_first, len(i)]), axis=0) + before[i]
            at = np.flatnonzero(i[1:] == i[:-1])
            features, cells = np.divmod(searched[i[at]], size)
            slots = np.searchsorted(begins, cells, side="right") - 1
            for s in np.unique(slots):
                some, f = at[slots == s], features[slots == s]
                units = _gains(upto[some], sizes[s])
                o = np.lexsort((v[some], f, -units))[0]
                yield int(s), (float(units[o]), int(f[o]), _middle(v[some[o]], v[some[o] + 1]), upto[some[o]])

    best: dict[int, tuple] = {}

    def offer(s, u, f, t, left):
        if u >= 0 and (s not in best or (u, -f, -t) > (best[s][0], -best[s][1], -best[s][2])):
            best[s] = (u, f, t, left)

    for s, got in blocks.mapPartitions(values).partitionBy(groups + 1, int).mapPartitions(search).collect():
        if s is not None:
            offer(s, *got)
            continue
        for (slot, f, _, _), (a, b) in zip(won, got):
            offer(slot, edge[slot][2], f, _middle(a, b), edge[slot][5])
    shared.unpersist()
    return {nodes[s]: b for s, b in best.items()}


def _middle(a: float, b: float) -> float:
    middle = a + (b - a) / 2
    return float(middle if middle < b else a)


def _summed(i: np.ndarray, v: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class counts by (cell, value), in that order."""
    o = np.lexsort((v, i))
    i, v = i[o], v[o]
    first = np.flatnonzero(np.r_[True, (i[1:] != i[:-1]) | (v[1:] != v[:-1])])
    return i[first], v[first], np.add.reduceat(n[o], first, axis=0)


def fit(train: DataFrame, features: Sequence[str], label: str = "label", classes: int = 2, local_rows: int = LOCAL_ROWS,
        levels: int | None = None, blocks: int = BINS) -> DataFrame:
    """The tree table of ``train``; labels are 0 .. classes - 1, other rows don't learn.

    ``levels``: stop there (rows below become leaves); default: no limit."""
    spark, width = train.sparkSession, len(features)
    ship_package(spark)
    y = F.col(label).cast("int")
    rows = materialize(train.where(y.between(0, classes - 1)).select(y.alias("y"), vector(features).alias("x")))
    counts = {r.y: r["count"] for r in rows.groupBy("y").count().collect()}
    if not counts:
        return spark.createDataFrame([], TREE)
    edges = _edges(rows, width, blocks)
    whole = _blocks(rows, edges).persist(StorageLevel.MEMORY_AND_DISK)
    most = max(len(e) for e in edges) + 1
    low, high = _extremes(whole, width, most)
    top, made, small, level, here = _Top(), [], {}, 0, whole
    open_ = {0: np.array([counts.get(k, 0) for k in range(classes)])}
    while open_:
        last = levels is not None and level >= levels
        large = {}
        for node, c in open_.items():
            if last or c.max() == c.sum():
                made.append((top.root[node], 0, None, None, None, None, None, int(c.sum()), int(c.argmax())))
            elif levels is None and c.sum() <= local_rows:
                small[node] = int(c.sum())
            else:
                large[node] = c
        if large and level and level % ROUTE_LEVELS == 0:
            # Rows of other nodes don't take part any more.
            before, here = here, here.map(_kept(top, list(large))).filter(lambda b: len(b[2])).persist(StorageLevel.MEMORY_AND_DISK)
            here.count()
            if before is not whole:
                before.unpersist()
        splits = _splits(here, top, large, classes, most, low, high) if large else {}
        open_ = {}
        for node, c in large.items():
            if node not in splits:  # nodes of equal rows have no split
                made.append((top.root[node], 0, None, None, None, None, None, int(c.sum()), int(c.argmax())))
                continue
            units, feature, threshold, left = splits[node]
            made.append((top.root[node], 0, feature, threshold, units / UNITS, -1, -1, int(c.sum()), int(c.argmax())))
            a, b = top.split(node, feature, threshold)
            open_ |= {a: np.asarray(left), b: c - np.asarray(left)}
        level += 1
    tree = spark.createDataFrame(made, TREE)
    if small:
        route = top.router()
        parts = max(4 * whole.getNumPartitions(), sum(small.values()) // max(1, local_rows))
        tree = tree.unionByName(finished(spark, whole, lambda b: (route(b[1], b[3]), (b[1], b[2])), small, top.root, parts,
                                         lambda _, v: grow(np.ascontiguousarray(v[0].T), v[1].astype(np.int64), classes)))
    tree = materialize(tree)
    whole.unpersist()
    here.unpersist()
    return tree


def _kept(top: _Top, nodes: list[int]):
    """The rows of a block that are in some nodes, with their nodes brought up to date."""
    route, open_ = top.router(), np.zeros(len(top.root), bool)
    open_[nodes] = True

    def run(block):
        code, x, y, at = block
        at = route(x, at)
        rows = np.flatnonzero(open_[at])
        return code.take(rows, axis=1), x.take(rows, axis=1), y[rows], at[rows].astype(np.int32)

    return run


# -- prediction --------------------------------------------------------------------

class _Arrays:
    """The whole tree as arrays, children as positions."""

    def __init__(self, tree: pa.Table):
        get = lambda c, none: tree.column(c).fill_null(none).to_numpy()
        # Nodes of a subtree follow each other, by number.
        root = pc.dictionary_encode(tree.column("root").combine_chunks())
        roots, root = root.dictionary.to_pylist(), root.indices.to_numpy()
        node, left, right = get("node", 0), get("left", -2), get("right", -2)
        order = np.lexsort((node, root))
        first = np.searchsorted(root[order], np.arange(len(roots)))
        at = {r: int(first[i]) for i, r in enumerate(roots)}
        below = np.array([[at.get(r + side, -1) for side in "01"] for r in roots], np.int32).reshape(-1, 2)
        root = root[order]
        # -1: the top of another subtree, -2: a leaf.
        self.left, self.right = (np.where(c == -1, below[root, i], np.where(c < 0, -1, first[root] + c)).astype(np.int32)
                                 for i, c in enumerate((left[order], right[order])))
        self.feature = get("feature", -1)[order].astype(np.int16)
        self.threshold, self.prediction = get("threshold", 0.0)[order], get("prediction", 0)[order].astype(np.int32)
        self.top = at.get("")

    def predict(self, x: np.ndarray) -> np.ndarray:
        node, todo = np.full(len(x), self.top), np.arange(len(x))
        while len(todo):
            f = self.feature[node[todo]]
            todo, f = todo[f >= 0], f[f >= 0]
            here = node[todo]
            node[todo] = np.where(x[todo, f] <= self.threshold[here], self.left[here], self.right[here])
        return self.prediction[node]


def predict(df: DataFrame, tree: DataFrame, features: Sequence[str], prediction: str = "prediction", values=numbers) -> DataFrame:
    """Append the class of every row (null for a tree without nodes); ``values``: columns of the features."""
    n = tree.count()
    if n == 0:
        return df.withColumn(prediction, F.lit(None).cast("int"))
    if n > BROADCAST_NODES:
        if tree.where("left = -1").count() > BROADCAST_NODES:
            return _predict_by_joins(df, tree, features, prediction, values)
        return _predict_by_roots(df, tree, features, prediction, values=values)
    arrays = df.sparkSession.sparkContext.broadcast(_Arrays(tree.drop("gain", "n").toArrow()))
    ship_package(df.sparkSession)
    return df.withColumn(prediction, row_function(lambda x: arrays.value.predict(x))(*values(features)))


def _predict_by_roots(df: DataFrame, tree: DataFrame, features: Sequence[str], prediction: str, share_rows: int = SHARE_ROWS,
                      values=numbers) -> DataFrame:
    """A tree beyond broadcasting: its distributed part leads every row to the subtree that ends
    it, and rows and nodes of a subtree meet, many rows in several shares."""
    spark, names = df.sparkSession, df.columns
    ship_package(spark)
    top, nodes = _Top(), [0]
    inner = {r.root: r for r in tree.where("left = -1").select("root", "feature", "threshold").collect()}
    for node in nodes:
        r = inner.get(top.root[node])
        if r is not None:
            nodes += top.split(node, r.feature, r.threshold)
    route, at = top.router(), len(names)

    def lead(batches):
        for b in batches:
            if b.num_rows:
                ends = route(_values(b.column(at)).T, np.zeros(b.num_rows, np.int64))
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(ends, pa.int32())], [*b.schema.names, "_at"])

    rows = df.withColumn("_x", F.array(*values(features)))
    rows = materialize(rows.mapInArrow(lead, StructType([*rows.schema.fields, StructField("_at", IntegerType())])))
    ends = spark.createDataFrame([(top.root[v], v) for v in nodes if top.left[v] < 0], "root string, _at int")
    shares = rows.groupBy("_at").count().select("_at", F.ceil(F.col("count") / share_rows).cast("int").alias("_n"))
    kept = tree.where("left is null or left <> -1").join(F.broadcast(ends), "root").join(F.broadcast(shares), "_at")
    kept = kept.select("_at", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)).alias("_share"), "node", "feature", "threshold", "left", "right", "prediction")
    dealt = rows.join(F.broadcast(shares), "_at").withColumn("_share", (F.monotonically_increasing_id() % F.col("_n")).cast("int")).drop("_n")
    schema = StructType([*df.schema.fields, StructField(prediction, IntegerType())])
    arrow = to_arrow_schema(schema)

    def run(left, right):
        if not left.num_rows:
            return arrow.empty_table()
        order = np.argsort(right.column("node").to_numpy())
        get = lambda c, none: right.column(c).combine_chunks().fill_null(none).to_numpy(zero_copy_only=False)[order]
        sub = _Arrays.__new__(_Arrays)
        sub.feature, sub.threshold, sub.left, sub.right = get("feature", -1), get("threshold", 0.0), get("left", -1), get("right", -1)
        sub.prediction, sub.top = get("prediction", 0), 0
        found = pa.array(sub.predict(_values(left.column("_x"))), pa.int32())
        return pa.table([*[left.column(c).cast(arrow.field(c).type) for c in names], found], schema=arrow)

    key = ("_at", "_share")
    return dealt.groupBy(*key).cogroup(kept.groupBy(*key)).applyInArrow(run, schema)


def _predict_by_joins(df: DataFrame, tree: DataFrame, features: Sequence[str], prediction: str, values=numbers) -> DataFrame:
    """A tree beyond broadcasting: rows step down together, one join with the tree a level."""
    names = df.columns
    rows = df.withColumn("_x", F.array(*values(features))).withColumns({"_root": F.lit(""), "_node": F.lit(0), prediction: F.lit(None).cast("int")})
    t = tree.select(*[F.col(c).alias(f"_t_{c}") for c in tree.columns])
    out = None
    while True:
        step = materialize(rows.join(t, (F.col("_root") == F.col("_t_root")) & (F.col("_node") == F.col("_t_node"))))
        done = step.where("_t_feature is null").withColumn(prediction, F.col("_t_prediction")).select(*names, prediction)
        out = done if out is None else out.unionByName(done)
        rest = step.where("_t_feature is not null")
        if rest.isEmpty():
            return out
        goes = F.get("_x", F.col("_t_feature")) <= F.col("_t_threshold")
        child = F.when(goes, F.col("_t_left")).otherwise(F.col("_t_right"))
        rows = rest.select(*names, "_x", F.when(child < 0, F.concat("_root", F.when(goes, "0").otherwise("1"))).otherwise(F.col("_root")).alias("_root"),
                           F.greatest(child, F.lit(0)).alias("_node"), prediction)
