"""From landed deals to enriched records: key filter, dedupe and lookup joins.

Canonical deal columns: ``snapshot_date, item_id, store_id, sale_price,
list_price, discount, rating_label, rating_pct`` (text) and the arrival order
``ord1, ord2``. Canonical detail columns: ``item_id, success, name, price, tags,
makers``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricetide.functions.text import store_label
from pricetide.operators.dedupe import ARRIVAL, ITEM_KEYS, keep_first
from pricetide.schemas import DEFAULT_STORES, STORE_LABEL_PREFIX

DETAIL_COLUMNS = ("name", "price", "tags", "makers")
RECORD_COLUMNS = (
    "snapshot_date",
    "item_id",
    *ARRIVAL,
    "name",
    "price",
    "sale_price",
    "list_price",
    "discount",
    "rating_label",
    "rating_pct",
    "store",
    "tags",
    "makers",
)
#: Where deals are sent together: a date, and a part of its items.
PART = "_part"
CELL = ("snapshot_date", PART)
#: With this option a join by cell and key takes rows that stand by cell as they are.
JOIN_IN_CELLS = ("spark.sql.requireAllClusterKeysForCoPartition", "false")


def require_key(df: DataFrame, key: str = "item_id") -> DataFrame:
    """Drop rows whose key is null or empty."""
    return df.filter(F.col(key).isNotNull() & (F.col(key) != ""))


def first_deals(
    deals: DataFrame,
    keys: Sequence[str] = ITEM_KEYS,
    order_by: Sequence[str] = ARRIVAL,
) -> DataFrame:
    """First deal per item and snapshot in arrival order, before any lookup."""
    return keep_first(require_key(deals), keys, order_by)


def lookup_details(
    deals: DataFrame, details: DataFrame, on: Sequence[str] = ("item_id",), how: str = "inner"
) -> DataFrame:
    """Attach item details; deals without a successful detail are dropped.

    ``details`` holds one row per ``on`` key. With details landed per snapshot,
    ``on=("snapshot_date", "item_id")`` lets the join reuse the exchange of the
    dedupe before it. No broadcast hint: Spark broadcasts ``details`` if its
    measured size is below the threshold and sort-merges otherwise.
    """
    found = details.filter(F.col("success")).select(*on, *DETAIL_COLUMNS)
    return deals.join(found, list(on), how)


def bring_details(deals: DataFrame, details: DataFrame) -> DataFrame:
    """``lookup_details`` by item for deals that stand by (snapshot, item) and are to stay so.

    Each item's dates go to its details, and these come to the deals of each date: the
    deals are neither shuffled towards the lookup nor, widened, back. Deals without a date
    are kept, without details: no snapshot holds them, and a write refuses them.
    """
    found = details.filter(F.col("success")).select("item_id", *DETAIL_COLUMNS)
    dates = deals.groupBy("item_id").agg(F.collect_set("snapshot_date").alias("dates"))
    dated = dates.join(found, "item_id").select(
        F.explode("dates").alias("snapshot_date"), "item_id", *DETAIL_COLUMNS, F.lit(True).alias("_found")
    )
    joined = deals.join(dated, list(ITEM_KEYS), "left")
    return joined.filter(F.col("_found") | F.col("snapshot_date").isNull()).drop("_found")


def store_dimension(stores: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """``store_id`` as text with the name that came last."""
    order = F.struct(*order_by) if len(order_by) > 1 else F.col(order_by[0])
    return (
        stores.withColumn("store_id", F.col("store_id").cast("string"))
        .groupBy("store_id")
        .agg(F.max_by("store_name", order).alias("store_name"))
    )


def default_stores(spark: SparkSession) -> DataFrame:
    """The fixed dimension for runs where the store list could not be fetched.

    As inline values its size is known when the join is planned, so it is
    broadcast and the deals are not shuffled.
    """
    pairs = ", ".join(f"('{store_id}', '{name}')" for store_id, name in DEFAULT_STORES)
    return spark.sql(f"SELECT * FROM VALUES {pairs} AS t(store_id, store_name)")


def label_stores(
    deals: DataFrame,
    stores: DataFrame,
    prefix: str = STORE_LABEL_PREFIX,
    on: Sequence[str] = ("store_id",),
) -> DataFrame:
    """Add ``store``, the label of ``store_id``; ``stores`` has one row per ``on`` key.

    Left join without a hint: a dimension below the broadcast threshold is
    broadcast, a larger one is sort-merged, where a store (or the null id) that
    holds much of the table is split by the adaptive skew join.
    """
    joined = deals.join(stores.select(*on, "store_name"), list(on), "left")
    label = store_label(F.col("store_id"), F.col("store_name"), prefix)
    return joined.withColumn("store", label).drop("store_name")


def enriched_records(
    deals: DataFrame,
    details: DataFrame,
    stores: DataFrame,
    on: Sequence[str] = ("item_id",),
) -> DataFrame:
    """Deals of one or many snapshots joined to one record per item and snapshot."""
    found = lookup_details(first_deals(deals), details, on)
    return label_stores(found, stores).select(*RECORD_COLUMNS)


def bring(rows: DataFrame, deals: DataFrame, key: str) -> DataFrame:
    """Rows of a lookup table, sent once to each cell where deals have their ``key``."""
    cells = deals.groupBy(key).agg(F.collect_set(F.struct(*CELL)).alias("_cells"))
    sent = rows.join(cells, key).select(*rows.columns, F.explode("_cells").alias("_cell"))
    return sent.select(*rows.columns, "_cell.*").repartition(*CELL)


def cells_of_dates(deals: DataFrame, cells: int) -> DataFrame:
    """Deals with the part of their date that they belong to, by a hash of the item.

    A date has as many parts as it holds of about ``cells`` in all, and one at least, so dates
    may be few or of uneven size. Counted first; one number a date reaches the driver.
    """
    counts = deals.groupBy("snapshot_date").agg(F.count("*").alias("n")).collect()
    total = sum(r.n for r in counts)
    parts = [(r.snapshot_date, -(-r.n * cells // total)) for r in counts]
    sizes = deals.sparkSession.createDataFrame(parts, "snapshot_date date, _parts bigint")
    known = deals.join(F.broadcast(sizes), "snapshot_date", "left")  # deals without a date are one part
    part = F.pmod(F.xxhash64("item_id"), F.coalesce("_parts", F.lit(1)))
    return known.select(*deals.columns, part.cast("int").alias(PART))


def records_by_date(
    deals: DataFrame, details: DataFrame, stores: DataFrame, cells: int
) -> DataFrame:
    """``enriched_records`` of many snapshots, each in few tasks and sorted by date there.

    Each deal is sent once, unsorted, to one of about ``cells`` cells: its date and a part of
    the items. There it is deduped, and store names and details are brought to it, so under
    ``JOIN_IN_CELLS`` neither a lookup, however large its table, nor a write by date moves the
    records again; without the option rows are the same and move more often. The keys of the
    deals are read once more for each lookup and for the sizes of the dates, and all deals of
    one item and date go to one task, repeats included.

    Deals without a date that have details come out as rows without a date and without
    values of the deal, for the write to refuse.
    """
    keyed = cells_of_dates(require_key(deals), cells)
    first = first_deals(keyed.repartition(*CELL), (*CELL, "item_id"))
    # hashed: to sort the deals by store would undo their order by item
    labels = bring(stores.select("store_id", "store_name"), keyed, "store_id").hint("shuffle_hash")
    labelled = label_stores(first, labels, on=(*CELL, "store_id"))
    known = details.filter(F.col("success")).select("item_id", "success", *DETAIL_COLUMNS)
    # dated details are there because of their deals, so "right" adds nothing but the undated
    found = lookup_details(labelled, bring(known, keyed, "item_id"), (*CELL, "item_id"), "right")
    return found.select(*RECORD_COLUMNS)


def rejection_audit(
    deals: DataFrame, details: DataFrame, on: Sequence[str] = ("item_id",)
) -> DataFrame:
    """Per snapshot: deals received, rejected by reason, and accepted.

    A deal counts once, in this order: unreadable (where ``deals`` keeps such records with
    their text in ``corrupt``), missing key, repeated key, failed lookup, accepted. Deals
    are first counted per key, so neither the missing key nor a hot item reaches one task
    row by row, and the lookup sees each key once.
    """
    kept = "corrupt" in deals.columns
    bad = F.col("corrupt").isNotNull() if kept else F.lit(False)
    key = F.when((F.col("item_id") != "") & ~bad, F.col("item_id"))
    per_key = (
        deals.select("snapshot_date", key.alias("item_id"), bad.alias("bad"))
        .groupBy(*ITEM_KEYS, "bad")
        .agg(F.count("*").alias("n"))
    )
    found = details.filter(F.col("success")).select(*on, F.lit(True).alias("found"))
    keyed, bad = F.col("item_id").isNotNull(), F.col("bad")
    total = lambda value: F.coalesce(F.sum(value), F.lit(0)).cast("bigint")
    unread = [total(F.when(bad, F.col("n"))).alias("n_unreadable")] if kept else []
    return (
        per_key.join(found, list(on), "left")
        .groupBy("snapshot_date")
        .agg(
            total(F.col("n")).alias("n_received"),
            *unread,
            total(F.when(~keyed & ~bad, F.col("n"))).alias("n_missing_key"),
            total(F.when(keyed, F.col("n") - 1)).alias("n_duplicate"),
            F.count_if(keyed & F.col("found").isNull()).alias("n_lookup_failed"),
            F.count_if(F.col("found")).alias("n_accepted"),
        )
    )
