"""Token budgets for a tree of domains, languages and sources, and the documents that fill them."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headingflow.llm.storage import drop, written

#: Epochs of a source that a mix may hold, at most.
MOST_EPOCHS = 4
SEED = 17
#: Leading hexadecimal digits of a document's key that make a bucket: 65,536 buckets for each leaf.
BUCKET_DIGITS = 4


def word_tokens(text: Column) -> Column:
    """Words between white space, as a measure of tokens; NULL has none."""
    spaces = " \t\n\x0b\f\r"
    bare = F.trim(F.coalesce(text, F.lit("")), F.lit(spaces))
    return F.when(bare == "", 0).otherwise(F.size(F.split(bare, r"[\x20\x09-\x0D]+"))).cast("long")


def _exact(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(38,0)")


def _shared_out(children: DataFrame, parent: Sequence[str], name: str) -> DataFrame:
    """Add ``grant`` to children with ``weight``, ``capacity`` and their parent's ``budget``.

    Each child gets its share by weight, but no more than its capacity, and what
    a full child leaves goes to its siblings by weight. In order of capacity
    over weight, a child is full if the budget still covers it at the rate that
    it and all later children would get. Whole numbers throughout.
    """
    order = Window.partitionBy(*parent).orderBy((F.col("capacity") / F.col("weight")), name)
    whole = Window.partitionBy(*parent)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    later = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    made = children.withColumns(
        {
            "_before": F.coalesce(F.sum("capacity").over(before), F.lit(0)),
            "_later": F.sum("weight").over(later),
        }
    ).withColumn(
        "_full",
        _exact("capacity") * _exact("_later") + _exact("weight") * _exact("_before")
        <= _exact("weight") * _exact("budget"),
    )
    made = made.withColumns(
        {
            "_used": F.coalesce(F.sum(F.when(F.col("_full"), F.col("capacity"))).over(whole), F.lit(0)),
            "_open": F.sum(F.when(~F.col("_full"), F.col("weight"))).over(whole),
        }
    )
    share = F.floor(_exact("weight") * _exact(F.col("budget") - F.col("_used")) / _exact("_open"))
    grant = F.when(F.col("_full"), F.col("capacity")).otherwise(F.least(share.cast("long"), F.col("capacity")))
    return made.withColumn("grant", grant).drop("_before", "_later", "_full", "_used", "_open", "budget")


def budgets(leaves: DataFrame, levels: Sequence[str], weights: DataFrame, budget: Column, epochs: int) -> DataFrame:
    """``levels, tokens, grant`` for each leaf of a tree; ``leaves`` has ``levels`` and ``tokens``.

    ``weights`` has a row ``level, name, weight`` for a node's whole-number
    weight among its siblings, at whatever place of the level it stands; others
    weigh 1. A node can take what its leaves hold in ``epochs`` epochs. Budgets
    go from the root down, so a shortage is met by siblings before it is felt
    above. The tables have a row for each node.
    """
    nodes = leaves.withColumn("capacity", F.col("tokens") * epochs)
    total = nodes.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("_all"), F.coalesce(F.sum("capacity"), F.lit(0)).alias("_most"))
    above = total.select(F.lit(0).alias("_root"), F.least(budget, F.col("_most")).cast("long").alias("budget"))
    parent = ["_root"]
    for depth, level in enumerate(levels):
        path = ["_root", *levels[: depth + 1]]
        here = nodes.withColumn("_root", F.lit(0)).groupBy(*path).agg(F.sum("capacity").alias("capacity"))
        own = weights.filter(F.col("level") == level).select(F.col("name").alias(level), "weight")
        here = here.join(own, level, "left").withColumn("weight", F.coalesce("weight", F.lit(1)).cast("long"))
        granted = _shared_out(here.join(above, parent), parent, level)
        above = granted.select(*path, F.col("grant").alias("budget"))
        parent = path
    return nodes.drop("capacity").join(above.drop("_root").withColumnRenamed("budget", "grant"), list(levels))


def _key(id_column: str, epoch: Column, seed: int) -> Column:
    """The place of a document in an epoch's order."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.col(id_column).cast("string")))


def mix(
    df: DataFrame,
    weights: DataFrame,
    levels: dict[str, Column],
    tokens: Column,
    id_column: str = "doc_id",
    share: float = 1.0,
    epochs: int = MOST_EPOCHS,
    seed: int = SEED,
    out: str = "copies",
) -> DataFrame:
    """Every row with ``out``: how often the mix holds it, 0 if not at all.

    The mix has ``share`` times the tokens of the table, dealt over the tree of
    ``levels``, expressions from the root's children down, by their names in
    ``weights``. A leaf gives its whole epochs first, then the documents of the
    next epoch in the order of a seeded hash as long as their tokens fit.

    The last document is found without sorting a leaf: sums over buckets of the
    hash tell the bucket in which the budget ends, and only its rows are put in
    order. Every row then compares its own hash with its leaf's last one, so
    texts are not shuffled unless the leaves outgrow a broadcast.

    NULL levels count as ``""``, NULL tokens as 0, a negative share as 0. Rows
    that repeat an id are taken or left together. An empty table stays empty.
    Columns of the table may bear the names of the levels.
    """
    spark = df.sparkSession
    path = list(levels)
    filled = {c: F.coalesce(e.cast("string"), F.lit("")) for c, e in levels.items()}
    narrow = df.select(
        F.col(id_column).alias("_id"),
        *[e.alias(c) for c, e in filled.items()],
        F.coalesce(tokens, F.lit(0)).cast("long").alias("_tokens"),
    )
    narrow, narrow_path = written(narrow, "narrow")
    leaves, leaves_path = written(narrow.groupBy(*path).agg(F.sum("_tokens").alias("tokens")), "leaves")
    whole = F.floor(F.col("_all") * max(0.0, share))
    granted = budgets(leaves, path, weights, whole, epochs)
    full = F.when(F.col("tokens") > 0, F.expr("grant div tokens")).otherwise(0)
    granted, granted_path = written(
        granted.withColumn("_full", full).withColumn("_rest", F.col("grant") - F.col("_full") * F.col("tokens")),
        "granted",
    )

    keyed = narrow.join(granted.select(*path, "_full", "_rest"), path).withColumn(
        "_key", _key("_id", F.col("_full") + 1, seed)
    )
    bucket = F.substring("_key", 1, BUCKET_DIGITS)
    sums = keyed.groupBy(*path, bucket.alias("_bucket")).agg(
        F.sum("_tokens").alias("_sum"), F.first("_rest").alias("_rest")
    )
    running = F.sum("_sum").over(Window.partitionBy(*path).orderBy("_bucket"))
    ends = sums.withColumn("_upto", running).filter(F.col("_upto") > F.col("_rest"))
    cut = ends.groupBy(*path).agg(
        F.min("_bucket").alias("_cut"), F.min(F.col("_upto")).alias("_upto"), F.min_by("_sum", "_bucket").alias("_sum")
    )
    cuts, cuts_path = written(
        cut.select(*path, "_cut", (F.col("_upto") - F.col("_sum")).alias("_before")), "cuts"
    )
    inside = keyed.join(cuts, path).filter(bucket == F.col("_cut"))
    # Rows with one id have one key and are summed together.
    upto = F.col("_before") + F.sum("_tokens").over(Window.partitionBy(*path).orderBy("_key"))
    last = (
        inside.withColumn("_upto", upto)
        .filter(F.col("_upto") <= F.col("_rest"))
        .groupBy(*path)
        .agg(F.max("_key").alias("_last"))
    )
    limits = (
        granted.select(*path, "_full")
        .join(cuts.select(*path, "_cut"), path, "left")
        .join(last, path, "left")
        # Without a cut the whole epoch fits; with one and no last row, all before its bucket.
        .withColumn("_limit", F.when(F.col("_cut").isNull(), F.lit("g")).otherwise(F.coalesce("_last", "_cut")))
        .select(*[F.col(c).alias(f"_leaf_{c}") for c in path], "_full", "_limit")
    )
    limits, _ = written(limits, "limits")
    drop(spark, narrow_path, leaves_path, granted_path, cuts_path)

    at_leaf = [filled[c] == F.col(f"_leaf_{c}") for c in path]
    key = _key(id_column, F.col("_full") + 1, seed)
    copies = F.col("_full") + F.when(key <= F.col("_limit"), 1).otherwise(0)
    return df.join(limits, at_leaf).select(*df.columns, copies.cast("long").alias(out))
