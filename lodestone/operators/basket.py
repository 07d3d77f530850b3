"""Baskets: pair counts, frequent item sets, association rules, lift matrix."""

from __future__ import annotations

import math

from pyspark import StorageLevel
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.session import cut_lineage

# Items of one basket handled together; a larger basket is split into blocks of this size.
BLOCK = 1_000


def basket_items(df: DataFrame, basket: str, item: str) -> DataFrame:
    """Distinct (basket, item) rows; repeats are folded inside each task before the shuffle."""
    rows = df.select(F.col(basket).alias("basket"), F.col(item).alias("item"))
    return rows.filter(F.col("basket").isNotNull() & F.col("item").isNotNull()).distinct()


def item_support(items: DataFrame) -> DataFrame:
    """Number of baskets per item."""
    return items.groupBy("item").agg(F.count(F.lit(1)).alias("freq"))


def frequent_items_only(items: DataFrame, min_count: int, few: bool = False) -> DataFrame:
    """Drop items in fewer than ``min_count`` baskets. Exact for any later support test at that
    level: a set is never more frequent than its rarest item. Where a ``few`` are left, they are
    sent to the rows; otherwise the rows may be shuffled by item before that is known."""
    keep = item_support(items).filter(F.col("freq") >= min_count).select("item")
    return items.join(F.broadcast(keep) if few else keep, "item", "left_semi")


def basket_pairs(df: DataFrame, basket: str, item: str, min_count: int = 1,
                 block: int = BLOCK) -> DataFrame:
    """Counts of unordered item pairs that share a basket: ``a`` < ``b``, ``n`` >= ``min_count``.

    Items that cannot reach ``min_count`` are dropped first. A basket larger than ``block`` is
    cut into blocks by item hash and its pairs are made per pair of blocks, so neither a task
    nor a row ever holds a whole oversized basket. Pairs are summed inside the task before
    they are shuffled.
    """
    items = basket_items(df, basket, item)
    if min_count > 1:
        items = frequent_items_only(items, min_count)
    oversized = (items.groupBy("basket").agg(F.count(F.lit(1)).alias("_n"))
                 .filter(F.col("_n") > block)
                 .select("basket", F.ceil(F.col("_n") / block).cast("int").alias("_blocks")))
    split = (items.join(oversized, "basket", "left")
             .withColumn("_blocks", F.coalesce("_blocks", F.lit(1)))
             .withColumn("_own", F.pmod(F.xxhash64("item"), F.col("_blocks")).cast("int"))
             .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))))
    cells = (split.groupBy("basket", F.least("_own", "_other").alias("_lo"),
                           F.greatest("_own", "_other").alias("_hi"))
             .agg(F.array_sort(F.collect_list(F.struct("item", "_own"))).alias("_t")))
    heads = cells.select("_lo", "_hi", "_t", F.posexplode("_t").alias("_i", "_a"))
    rest = F.slice("_t", F.col("_i") + 2, F.size("_t"))
    # Inside one block every pair counts; between two blocks only the pairs that cross.
    crossing = F.filter(rest, lambda x: x["_own"] != F.col("_a._own"))
    partners = F.when(F.col("_lo") == F.col("_hi"), rest).otherwise(crossing)
    pairs = heads.select(F.col("_a.item").alias("a"), F.explode(partners).alias("_b"))
    counts = (pairs.select("a", F.col("_b.item").alias("b"))
              .groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")))
    return counts if min_count <= 1 else counts.filter(F.col("n") >= min_count)


def top_pairs(df: DataFrame, basket: str, item: str, k: int, head: int = 256,
              block: int = BLOCK) -> DataFrame:
    """The ``k`` commonest item pairs, and perhaps more: all pairs that can be among them.

    A pair is never more frequent than its rarer item. The pairs of the ``head`` commonest items are
    counted first; the k-th best of them is a floor. If the items outside are rarer than the floor,
    these pairs are all that is needed; else only items of the floor's support are paired. Where the
    floor is no help (it is 1), more items come first. A basket of many items thus makes few pairs,
    and what is left of it is cut into blocks by :func:`basket_pairs`.
    """
    items = cut_lineage(basket_items(df, basket, item))
    support = cut_lineage(item_support(items))
    kinds = support.count()
    while True:
        first = support.orderBy(F.desc("freq"), F.asc("item")).limit(head)
        common = basket_pairs(items.join(first.select("item"), "item", "left_semi"),
                              "basket", "item", 1, block)
        best = common.orderBy(F.desc("n")).limit(k).agg(
            F.count(F.lit(1)).alias("found"), F.min("n").alias("floor")).first()
        floor = best["floor"] if best["found"] == k else 0
        if head >= kinds or floor > first.agg(F.min("freq")).first()[0]:
            return common
        if floor > 1:
            return basket_pairs(items, "basket", "item", floor, block)
        head *= 8


def basket_count(df: DataFrame, basket: str, item: str) -> DataFrame:
    """One row: the number of non-empty baskets."""
    return (df.filter(F.col(basket).isNotNull() & F.col(item).isNotNull())
            .agg(F.countDistinct(basket).alias("n_baskets")))


def frequent_itemsets(df: DataFrame, basket: str, item: str,
                      min_support: float = 0.05) -> DataFrame:
    """Item sets in at least ``min_support`` of the baskets: ``items`` (sorted), ``freq``,
    ``support``, ``n_baskets``.

    Infrequent items go first. What is left of a basket is then bounded: there are at most
    (mean basket size / ``min_support``) frequent items in all. FP-growth mines the rest in
    parallel, one conditional tree per item group. Equal baskets are dealt together, so that each
    task's trees hold its share of the different baskets and not nearly all of them; what is much
    repeated may be split over tasks again.

    ``df`` is read once: its distinct rows lie on the executors' disks for the number of baskets, the
    supports and the baskets. The frequent items go to all tasks, as FP-growth sends them anyway.
    """
    items = basket_items(df, basket, item).persist(StorageLevel.DISK_ONLY)
    baskets = None
    try:
        total = basket_count(items, "basket", "item").first()[0]
        min_count = max(1, math.ceil(round(min_support * total, 6)))
        common = frequent_items_only(items, min_count, few=True)
        baskets = common.groupBy("basket").agg(F.array_sort(F.collect_list("item")).alias("items"))
        baskets = baskets.select("items").hint("rebalance", F.col("items")).persist()
        kept = baskets.count()
        if kept == 0:
            schema = df.select(F.array(item).alias("items")).schema["items"].dataType
            empty = df.sparkSession.createDataFrame([], "freq long").select(
                F.lit(None).cast(schema).alias("items"), "freq")
            found = empty
        else:
            # Half a basket below the wanted count, so that rounding up lands on it exactly.
            miner = FPGrowth(itemsCol="items", minSupport=(min_count - 0.5) / kept,
                             minConfidence=1.0)
            # Mined while the baskets are held, and kept: later reads do not mine again.
            found = cut_lineage(miner.fit(baskets).freqItemsets)
    finally:
        if baskets is not None:
            baskets.unpersist()
        items.unpersist()
    return found.select(F.array_sort("items").alias("items"), "freq",
                        (F.col("freq") / F.lit(total)).alias("support"),
                        F.lit(total).cast("long").alias("n_baskets"))


def association_rules(itemsets: DataFrame, min_confidence: float = 0.3, min_lift: float = 1.0,
                      k: int | None = 20) -> DataFrame:
    """Rules with confidence >= ``min_confidence`` and lift > ``min_lift``, best lift first.

    Every split of a frequent set into antecedent and consequent is tried, so consequents may
    hold several items. Supports come from two joins with the item sets themselves.
    """
    size = F.size("items")
    masks = F.expr("sequence(1, shiftleft(1, size(items)) - 2)")

    def side(bit: int):
        return F.filter("items", lambda x, i: F.getbit(F.col("_mask"), i) == bit)

    splits = (itemsets.filter(size > 1).withColumn("_mask", F.explode(masks))
              .select(side(1).alias("antecedent"), side(0).alias("consequent"),
                      F.col("freq").alias("_f"), F.col("n_baskets").alias("_n")))
    one = itemsets.select(F.col("items").alias("antecedent"), F.col("freq").alias("_fa"))
    two = itemsets.select(F.col("items").alias("consequent"), F.col("freq").alias("_fc"))
    rules = (splits.join(one, "antecedent").join(two, "consequent")
             .select("antecedent", "consequent",
                     (F.col("_f") / F.col("_n")).alias("support"),
                     (F.col("_f") / F.col("_fa")).alias("confidence"),
                     (F.col("_f") * F.col("_n") / (F.col("_fa") * F.col("_fc"))).alias("lift"))
             .filter((F.col("confidence") >= min_confidence) & (F.col("lift") > min_lift)))
    if k is None:
        return rules
    return rules.orderBy(F.desc("lift"), F.asc("antecedent"), F.asc("consequent")).limit(k)


def lift_cells(rules: DataFrame) -> DataFrame:
    """Lift of every ordered item pair of the given rules, long form, 0 where no rule has it.

    Where several rules cover a pair, the weakest of them is shown. The grid spans the items
    of the (already cut) rules: a report-sized frame. The rules are computed once: the cells are
    kept, and the items of the grid are read from them.
    """
    pairs = (rules.select(F.explode("antecedent").alias("antecedent"), "consequent", "lift")
             .select("antecedent", F.explode("consequent").alias("consequent"), "lift"))
    cells = cut_lineage(pairs.groupBy("antecedent", "consequent").agg(F.min("lift").alias("lift")))
    names = cells.select(F.explode(F.array("antecedent", "consequent")).alias("item"))
    all_items = names.agg(F.array_sort(F.collect_set("item"))).scalar()
    grid = (names.distinct().withColumnRenamed("item", "antecedent")
            .withColumn("consequent", F.explode(all_items)))
    return (grid.join(cells, ["antecedent", "consequent"], "left")
            .withColumn("lift", F.coalesce("lift", F.lit(0.0))))


def lift_matrix(rules: DataFrame) -> DataFrame:
    """The grid of :func:`lift_cells` as a square matrix, one column per item."""
    cells = lift_cells(rules)
    names = sorted(r[0] for r in cells.select("antecedent").distinct().collect())
    return (cells.groupBy("antecedent").pivot("consequent", names).agg(F.first("lift"))
            .orderBy("antecedent"))
