"""Train / validation / test splits that do not depend on partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from creditspark import schema as S
from creditspark.functions.numeric import bind

HASH_BITS = 60
BLOCK_BITS = 16


def hash_position(id_col: Column, seed: int) -> Column:
    """Seeded 60-bit position of an id, uniform in [0, 2^60); a null id counts as an empty one."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long")


def hash_split(
    df: DataFrame,
    test_size: float = 0.20,
    val_size: float = 0.10,
    id_col: str = S.ID_COLUMN,
    seed: int = 42,
) -> DataFrame:
    """Adds ``split`` by hash threshold: narrow, reproducible, one id in one split.

    Each class is split in the given shares up to sampling error; use
    ``exact_stratified_split`` where the sizes must hold to the row.
    """
    h = hash_position(F.col(id_col), seed)
    span = 2**HASH_BITS
    test_end = int(test_size * span)
    val_end = int((test_size + val_size) * span)
    label = bind(h, lambda x: F.when(x < test_end, "test").when(x < val_end, "val").otherwise("train"))
    return df.withColumn("split", label)


def _quota(counts: DataFrame, target: str, draws: Column, size: str, out: str) -> DataFrame:
    """Share ``draws`` over the classes in proportion to ``size``, largest remainder first."""
    everyone = Window.partitionBy()
    by_remainder = Window.orderBy(F.col("_rest").desc(), F.col(target))
    exact = draws * F.col(size) / F.sum(size).over(everyone)
    return (
        counts.withColumn("_exact", exact)
        .withColumn("_floor", F.floor("_exact"))
        .withColumn("_rest", F.col("_exact") - F.col("_floor"))
        .withColumn("_left", (draws - F.sum("_floor").over(everyone)))
        .withColumn(
            out,
            F.col("_floor") + F.when(F.row_number().over(by_remainder) <= F.col("_left"), 1).otherwise(0),
        )
        .drop("_exact", "_floor", "_rest", "_left")
    )


def split_quotas(
    df: DataFrame, test_size: float = 0.20, val_size: float = 0.10, target: str = S.TARGET_COLUMN
) -> DataFrame:
    """(target, n, n_test, n_val): rows each class gives to each part.

    Totals round up, as the usual two-step stratified split does. The table has one
    row per class, so its windows stay small whatever the size of ``df``.
    """
    everyone = Window.partitionBy()
    counts = df.groupBy(target).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(everyone)
    with_test = _quota(
        counts.withColumn("_test", F.ceil(total * F.lit(test_size))),
        target, F.col("_test"), "n", "n_test",
    )
    rest = with_test.withColumn("_rest_n", F.col("n") - F.col("n_test"))
    rest_total = F.sum("_rest_n").over(everyone)
    share = val_size / (1.0 - test_size)
    return _quota(
        rest.withColumn("_val", F.ceil(rest_total * F.lit(share))),
        target, F.col("_val"), "_rest_n", "n_val",
    ).select(target, "n", "n_test", "n_val")


def _cutoffs(hashed: DataFrame, quotas: DataFrame, target: str) -> DataFrame:
    """Per class, the position that ends the test part and the one that ends the val part.

    Counting by the top bits of the hash narrows each cut-off to one block; only the
    rows of those few blocks are then ordered. A class of any size is handled without
    sorting it, and copies of one id are counted together first.
    """
    shift = HASH_BITS - BLOCK_BITS
    blocks = (
        hashed.groupBy(target, F.shiftright("_h", shift).alias("_block"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    run = Window.partitionBy(target).orderBy("_block").rowsBetween(Window.unboundedPreceding, 0)
    wanted = quotas.select(
        F.col(target).alias("_class"),
        F.explode(
            F.array(
                F.struct(F.lit("test").alias("part"), F.col("n_test").alias("rank")),
                F.struct(F.lit("val").alias("part"), (F.col("n_test") + F.col("n_val")).alias("rank")),
            )
        ).alias("_w"),
    ).select("_class", "_w.part", "_w.rank")
    edge_blocks = (
        blocks.withColumn("_end", F.sum("_n").over(run))
        .join(wanted, F.col(target).eqNullSafe(F.col("_class")))
        .filter((F.col("rank") > F.col("_end") - F.col("_n")) & (F.col("rank") <= F.col("_end")))
        .select("_class", "part", F.col("_block").alias("_edge"), (F.col("rank") - F.col("_end") + F.col("_n")).alias("_need"))
    )
    inside = (
        hashed.join(
            edge_blocks, F.col(target).eqNullSafe(F.col("_class")) & (F.shiftright("_h", shift) == F.col("_edge"))
        )
        .groupBy("_class", "part", "_need", "_h", "_id")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    order = Window.partitionBy("_class", "part").orderBy("_h", "_id").rowsBetween(Window.unboundedPreceding, 0)
    return (
        inside.withColumn("_reached", F.sum("_n").over(order))
        .filter(F.col("_reached") >= F.col("_need"))
        .groupBy("_class")
        .pivot("part", ["test", "val"])
        .agg(F.min(F.struct("_h", "_id")))
        .select("_class", F.col("test").alias("_test"), F.col("val").alias("_val"))
    )


def exact_stratified_split(
    df: DataFrame,
    test_size: float = 0.20,
    val_size: float = 0.10,
    target: str = S.TARGET_COLUMN,
    id_col: str = S.ID_COLUMN,
    seed: int = 42,
) -> DataFrame:
    """Adds ``split`` with the exact per-class sizes of ``split_quotas``.

    Within a class (a null target is a class too) the rows go to test, then val, then train in
    the order of their hash and, where hashes meet, of their id. Rows with the same id are
    never separated. The cut-offs have one row per class.
    """
    text_id = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    hashed = df.withColumns({"_h": hash_position(F.col(id_col), seed), "_id": text_id})
    quotas = split_quotas(df, test_size, val_size, target)
    cut = _cutoffs(hashed.select(target, "_h", "_id"), quotas, target)
    place = F.struct("_h", "_id")
    return (
        hashed.join(cut, F.col(target).eqNullSafe(F.col("_class")), "left")
        .withColumn("split", F.when(place <= F.col("_test"), "test").when(place <= F.col("_val"), "val").otherwise("train"))
        .drop("_h", "_id", "_class", "_test", "_val")
    )


def split_summary(df: DataFrame, target: str = S.TARGET_COLUMN) -> DataFrame:
    """Rows, defaults and default rate per split."""
    return df.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(target).alias("n_defaults"),
        F.avg(target).alias("default_rate"),
    )


def split_overlap(df: DataFrame, id_col: str = S.ID_COLUMN) -> DataFrame:
    """Ids present in more than one split; empty for a sound split."""
    return (
        df.groupBy(id_col)
        .agg(F.min("split").alias("first_split"), F.max("split").alias("last_split"))
        .filter(F.col("first_split") != F.col("last_split"))
    )


def split_intersection(df: DataFrame, left: str, right: str, id_col: str = S.ID_COLUMN) -> DataFrame:
    """Ids that lie in both parts, each once; a missing id counts as an id.

    ``df`` is read once: with the rows of ``right`` before those of ``left``, an id in both has one row
    where they meet. The rows are sorted by id, as a join of the parts would do, and ids are not
    gathered in a table before the exchange, since few come twice in one task.
    """
    rows = df.filter(F.col("split").isin(left, right)).select(id_col, (F.col("split") == left).alias("_left"))
    if left == right:
        return rows.select(id_col).distinct()
    in_order = Window.partitionBy(id_col).orderBy("_left")
    return rows.withColumn("_before", F.lag("_left").over(in_order)).filter("_left AND NOT _before").select(id_col)


def split_cover(df: DataFrame, parts: DataFrame, id_col: str = S.ID_COLUMN) -> DataFrame:
    """Rows missing from the parts, and rows the parts have too many of, by id."""
    whole, split = df.select(id_col), parts.select(id_col)
    return union_sides(whole.exceptAll(split), split.exceptAll(whole))


def union_sides(missing: DataFrame, extra: DataFrame) -> DataFrame:
    return missing.withColumn("side", F.lit("missing")).unionByName(extra.withColumn("side", F.lit("extra")))
