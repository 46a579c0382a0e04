"""Illicit-address label tables and the labelled-input join.

Every grouping here is a hash aggregation (partial aggregation on the map side),
never a window over the account key: one account may own a third of all label
rows and must still cost one pre-aggregated row per map task in the shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Category ids of the category file that count as illicit
# (blackmail, darknet market, gambling, government blacklist, money laundering,
# ponzi scheme).
ILLICIT_CATEGORIES = (0, 2, 6, 7, 8, 9)

REPORT_PAGE_SCHEMA = "data ARRAY<STRUCT<address: STRING>>"


def category_labels(feed: DataFrame, keep=ILLICIT_CATEGORIES, account: str = "account",
                    label: str = "label") -> DataFrame:
    """Keep the illicit categories and mark them ``label = 1``."""
    return (feed.where(F.col(label).isin(list(keep)))
            .select(F.col(account).alias("account"), F.lit(1).alias("label")))


def report_labels(reports: DataFrame, account: str = "account") -> DataFrame:
    """Every reported address is illicit (A7): ``(account, label = 1)``, one row per report."""
    return reports.select(F.col(account).alias("account"), F.lit(1).alias("label"))


def explode_report_pages(pages: DataFrame, column: str = "data") -> DataFrame:
    """Report pages ``{"data": [{"address": ..}, ..]}`` -> one row per address.

    ``column`` may be the parsed array or a JSON text column holding whole pages.
    """
    dtype = dict(pages.dtypes)[column]
    arr = (F.from_json(F.col(column), REPORT_PAGE_SCHEMA)["data"] if dtype == "string"
           else F.col(column))
    return (pages.select(F.explode(arr).alias("r"))
            .select(F.col("r.address").alias("account"), F.lit(1).alias("label")))


def parse_report_props(reports: DataFrame, column: str = "props", schema: str = "k INT") -> DataFrame:
    """Flatten a JSON text column into typed columns (schema declared, no inference)."""
    parsed = F.from_json(F.col(column), schema)
    fields = [f.strip().split()[0] for f in schema.split(",")]
    return reports.select(*[c for c in reports.columns if c != column],
                          *[parsed[f].alias(f) for f in fields])


def label_union(feeds: dict, rank: bool = False) -> DataFrame:
    """UNION ALL of label feeds, tagged with the feed name (G1).

    With ``rank`` the feed's position (0, 1, ...) is added as ``source_rank``,
    the survivor order used by ``illicit_label_table``.
    """
    tagged = []
    for i, (name, df) in enumerate(feeds.items()):
        cols = [F.col("account"), F.col("label"), F.lit(name).alias("source")]
        if rank:
            cols.append(F.lit(i).alias("source_rank"))
        tagged.append(df.select(*cols))
    return reduce(lambda a, b: a.unionByName(b), tagged)


def duplicate_audit(labels: DataFrame, keys=("account",)) -> DataFrame:
    """Key groups with more than one row."""
    return (labels.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 1))


def dedupe_labels(labels: DataFrame, key: str = "account", order=("source",)) -> DataFrame:
    """One row per ``key`` (C9), keeping the row that sorts first by ``order``.

    Implemented as ``min(struct(order..., rest...))`` per key: a hash aggregation
    with partial aggregation, so a hot key is collapsed map-side, and the
    survivor is deterministic (no arbitrary row_number tie order).
    """
    rest = [c for c in labels.columns if c != key and c not in order]
    best = F.min(F.struct(*[F.col(c) for c in order], *[F.col(c) for c in rest])).alias("_best")
    return labels.groupBy(key).agg(best).select(key, *[F.col(f"_best.{c}").alias(c) for c in labels.columns
                                                      if c != key])


def dedupe_by_rank(labels: DataFrame, names, key: str = "account", rank: str = "source_rank") -> DataFrame:
    """One row per ``key`` from the feed with the lowest ``rank``.

    Only fixed-width aggregation buffers (``min`` of an int, ``min_by`` of an
    int label by an int rank), so Spark runs a hash aggregation with map-side
    partial aggregation: a hot account costs one row per map task. The feed
    name comes back from the rank through a literal array of the feed names.
    """
    best = labels.groupBy(key).agg(F.min(rank).alias(rank), F.min_by("label", rank).alias("label"))
    name_of = F.element_at(F.array(*[F.lit(n) for n in names]), F.col(rank) + 1)
    return best.select(key, "label", name_of.alias("source"))


def illicit_label_table(feeds: dict) -> DataFrame:
    """The de-duplicated ``(account, label, source)`` table from several feeds;
    on a repeated account the earlier feed wins."""
    return dedupe_by_rank(label_union(feeds, rank=True), list(feeds))


def label_inputs(inputs: DataFrame, labels: DataFrame, tx: DataFrame,
                 tx_columns=("input_count", "output_total", "output_total_usd", "fee_usd")) -> DataFrame:
    """Inputs LEFT JOIN labels on account, INNER JOIN transactions on hash.

    Missing labels become 0 (B19). Both joins are many-to-one lookups; AQE picks
    broadcast when the looked-up side is small at run time and splits skewed
    partitions (hot accounts / hashes) otherwise. Clashing transaction columns
    get a ``tx_`` prefix.
    """
    lab = labels.select("account", F.col("label").alias("_label"))
    txs = tx.select("hash", *[F.col(c).alias(f"tx_{c}") if c in inputs.columns else F.col(c)
                              for c in tx_columns])
    # Hash join first: inputs and transactions are both keyed by the
    # transaction hash (co-partitioned when they come from the same line join),
    # then one shuffle (or broadcast) for the account lookup.
    j = inputs.join(txs, "hash", "inner").join(lab, "account", "left")
    return (j.withColumn("label", F.coalesce(F.col("_label"), F.lit(0)).cast("int"))
            .drop("_label"))


def fill_missing(df: DataFrame, value=0, columns=None) -> DataFrame:
    """Null -> ``value`` in numeric columns and null -> false in booleans (B19); ``columns``: only these."""
    types = [(c, t) for c, t in df.dtypes if columns is None or c in columns]
    num = [c for c, t in types if t in ("int", "bigint", "double", "float", "smallint", "tinyint")
           or t.startswith("decimal")]
    boo = [c for c, t in types if t == "boolean"]
    out = df.fillna(value, subset=num) if num else df
    return out.fillna(False, subset=boo) if boo else out
