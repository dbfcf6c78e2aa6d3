"""Mixing sources to target weights by Efraimidis-Spirakis sampling."""

from __future__ import annotations

from itertools import chain, count

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from viewmill.llm.common import join_documents, staged, with_key

WEIGHTS, SHARE, MOST_EPOCHS = (3, 1, 2), 1.5, 2
#: Documents that one sorted range of keys has on average, if that makes more ranges than shuffles have partitions.
RANGE_ROWS = 100_000


def quality_weight(text: Column) -> Column:
    """1 to 5: five grades by the share of letters and blanks among the characters."""
    plain = F.length(F.regexp_replace(text, r"[^\p{L}\s]+", ""))
    return F.lit(1) + F.floor(F.lit(4) * plain / F.greatest(F.length(text), F.lit(1)))


def _in_ranges(rows: DataFrame, name: str, order: list[Column]) -> DataFrame:
    """``rows`` dealt out by ranges of an order and written, with the number of their ``range``.

    A task that is repeated later finds the same ranges. ``rows`` is read for its count, for the bounds and for the rows.
    """
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(partitions, rows.count() // RANGE_ROWS)
    return staged(rows.repartitionByRange(ranges, *order).withColumn("range", F.spark_partition_id()), name)


def source_targets(
    sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most_epochs: int = MOST_EPOCHS
) -> DataFrame:
    """``source``, ``source_size``, ``target`` from ``source``, ``source_size`` (one row per source).

    Sources by code point, null last, get ``weights`` in turn. Targets share ``share`` times all words by weight, stop
    at ``most_epochs`` times the source, and the excess goes to the others by weight until none is above. Each round
    is one aggregate over the rows of ``sizes``; only its sums reach the driver. Sources are numbered in ranges, so
    there may be very many (hosts, say).
    """
    by_name = F.col("source").asc_nulls_last()
    ranged = _in_ranges(sizes.select("source", "source_size"), "sources", [by_name])
    counts = ranged.groupBy("range").agg(F.count("*").alias("n"))
    earlier = F.coalesce(F.sum("n").over(W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    # One row per range.
    offsets = counts.select(F.col("range").alias("of"), earlier.alias("earlier"))
    inside = F.row_number().over(W.partitionBy("range").orderBy(by_name)) - 1
    placed = ranged.withColumn("inside", inside).join(offsets, F.col("range") == F.col("of"))
    place = (F.col("earlier") + F.col("inside")) % len(weights)
    weight = F.get(F.array(*[F.lit(w) for w in weights]), place.cast("int"))
    table = staged(placed.select("source", "source_size", weight.alias("weight")), "weights")
    most = F.col("source_size") * most_epochs
    total = share * (table.agg(F.sum("source_size")).first()[0] or 0)
    level, bound = 0.0, F.lit(False)
    while True:
        now = table.agg(
            F.sum(F.when(bound, most).otherwise(0)).alias("fixed"),
            F.sum(F.when(bound, 0).otherwise(F.col("weight"))).alias("open"),
            F.sum(F.when(bound, 1).otherwise(0)).alias("n"),
        ).first()
        if not now["open"]:
            break
        level = (total - now["fixed"]) / now["open"]
        above = bound | (F.col("weight") * level > most)
        if table.where(above).count() == now["n"]:
            break
        # A source once at its bound stays there, since the level only rises.
        bound = above
    target = F.when(bound, most.cast("double")).otherwise(F.col("weight") * F.lit(float(level)))
    return table.select("source", "source_size", target.alias("target"))


def mix_sources(
    docs: DataFrame,
    weights: tuple = WEIGHTS,
    share: float = SHARE,
    most_epochs: int = MOST_EPOCHS,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    seed: str = "mix",
) -> DataFrame:
    """One row per row of ``docs``: ``id``, ``mark``, ``source``, ``size``, ``source_size``, ``target``, ``epochs``, ``taken``.

    All documents of a source are taken for as many complete epochs as its target holds. The rest of the target is
    filled by documents in the order of their keys -ln(u) / quality weight, u from a hash of the id; the document at
    the end of the budget is taken in part. Rows are dealt out by ranges of (source, key) whatever the keys'
    distribution is, summed within a range, and ranges are added up per source, so a source with a third of all rows is
    sorted and summed by many tasks. Nothing is random: reruns agree.

    Null texts have size 0 and take nothing; very long texts count whole. A null source is a source, the last one. Equal
    keys are ordered by id and text. Repeated rows are taken one after the other. Other columns are not read and may
    have any name. An empty table gives an empty table.
    """
    keyed = with_key(docs, id_column, text_column)
    digits = F.substring(F.md5(F.concat_ws("\x1f", F.lit(seed), F.col("id").cast("string"))), 1, 12)
    chance = (F.conv(digits, 16, 10).cast("double") + 0.5) / float(16**12)
    stats = staged(
        keyed.select(
            "id",
            "mark",
            F.col("row").getField(source_column).alias("source"),
            F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("size"),
            (-F.log(chance) / quality_weight(F.col("text"))).alias("key"),
        ),
        "sizes",
    )
    sizes = stats.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = staged(source_targets(sizes, weights, share, most_epochs), "targets")
    order = [F.col(c) for c in ("key", "id", "mark")]
    stats = _in_ranges(stats, "mix", [F.col("source"), *order])
    sums = stats.groupBy("source", "range").agg(F.sum("size").alias("range_size"))
    ranges_before = W.partitionBy("source").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.withColumn("earlier", F.coalesce(F.sum("range_size").over(ranges_before), F.lit(0)))
    plan = sums.join(targets.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).select(
        F.col("source").alias("of"), F.col("range").alias("in_range"), "earlier", "source_size", "target"
    )
    joined = stats.join(plan, F.col("source").eqNullSafe(F.col("of")) & (F.col("range") == F.col("in_range")))
    before = F.sum("size").over(
        W.partitionBy("source", "range").orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    budget = F.round("target").cast("long") - F.col("epochs") * F.col("source_size")
    left = F.col("budget") - F.col("earlier") - (F.col("through") - F.col("size"))
    return (
        joined.withColumn("through", before)
        .withColumn("epochs", epochs)
        .withColumn("budget", budget)
        .select(
            "id",
            "mark",
            "source",
            "size",
            "source_size",
            "target",
            "epochs",
            (F.col("epochs") * F.col("size") + F.greatest(F.least(left, F.col("size")), F.lit(0)))
            .cast("long")
            .alias("taken"),
        )
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """``docs`` that the mix takes, and last a struct of size, source_size, target and taken.

    The struct is called ``mix``, or ``mix_2``, ``mix_3`` and so on if ``docs`` has a column of that name in any case; all
    columns of ``docs`` are kept. Rows that agree in id and text share equally, rounded down, what they take together; if
    that is less than one word each, they are not taken. Null and empty texts are not taken. An empty table gives an
    empty table.
    """
    mix = mix_sources(docs, **options).groupBy("id", "mark").agg(
        F.max("size").alias("size"),
        F.max("source_size").alias("source_size"),
        F.max("target").alias("target"),
        F.floor(F.sum("taken") / F.count("*")).alias("taken"),
    )
    mix = mix.where("taken > 0")
    keyed = with_key(docs, options.get("id_column", "doc_id"), options.get("text_column", "text"))
    joined = join_documents(keyed, mix, "inner")
    used = {c.lower() for c in docs.columns}
    name = next(n for n in chain(["mix"], (f"mix_{i}" for i in count(2))) if n not in used)
    return joined.select(
        *[F.col("row").getField(c).alias(c) for c in docs.columns],
        F.struct("size", "source_size", "target", "taken").alias(name),
    )
