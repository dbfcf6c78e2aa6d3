"""Crowded regions of the forest, made exact: what a bounded comparison left apart is compared in blocks."""

from __future__ import annotations

from collections.abc import Iterator
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewmill.llm.common import documents_of, join_documents, staged
from viewmill.llm.components import connected_components
from viewmill.llm.words import shingle_sets

LINK = "a1 long, a2 long, b1 long, b2 long"


def _level(percent: int) -> Column:
    """Steps of size: sets in steps further apart than one cannot be similar enough, whatever they hold."""
    step = max(log(100 / percent) * 1.0001, 1e-6)
    return F.floor(F.log(F.col("n_shingles").cast("double")) / step)


class _Index:
    """Shingles of the rows that are asked for, with their owners."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets])
        values = np.concatenate(sets)
        order = np.argsort(values, kind="stable")
        self.values = values[order]
        self.owners = np.repeat(np.arange(len(sets)), self.sizes)[order]

    def near(self, found: np.ndarray, percent: int) -> np.ndarray:
        low = np.searchsorted(self.values, found, "left")
        times = np.searchsorted(self.values, found, "right") - low
        at = np.repeat(low - (np.cumsum(times) - times), times) + np.arange(times.sum())
        both = np.bincount(self.owners[at], minlength=len(self.sizes))
        return np.flatnonzero(100 * both >= percent * (self.sizes + len(found) - both))


def _links(size: int, percent: int):
    """Links of each block's asked rows, which come first, with all rows of the block in another component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, asked, sets, index, seen = None, [], [], None, set()
        for batch in batches:
            out = []
            names = ("region", "level", "block", "part", "asked", "c1", "c2", "k1", "k2")
            columns = zip(*[batch[c].to_pylist() for c in names], strict=True)
            for (*block, first, c1, c2, k1, k2), found in zip(columns, shingle_sets(batch["text"], size), strict=True):
                if block != here:
                    here, asked, sets, index, seen = block, [], [], None, set()
                if first:
                    asked.append((c1, c2, k1, k2))
                    sets.append(found)
                    continue
                if not asked:
                    continue
                if index is None:
                    index, sets = _Index(sets), []
                for i in index.near(found, percent):
                    a1, a2, *other = asked[i]
                    pair = (*other, k1, k2)
                    if other != [k1, k2] and pair not in seen:
                        seen.add(pair)
                        out.append((a1, a2, c1, c2))
            parts = list(zip(*out, strict=True)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in parts], ["a1", "a2", "b1", "b2"])

    return run


def completed_components(
    members: DataFrame, groups: DataFrame, keyed: DataFrame, percent: int, size: int, block: int, block_chars: int, split: int
) -> DataFrame:
    """``groups`` (``node``, ``label``) after all links within crowded regions.

    ``members``: ``region``, ``c1``, ``c2``, ``id``, ``mark``, ``n_shingles``, ``chars`` of all rows in such regions.
    A region whose rows are in one component has nothing to add. In any other, each row outside its largest component is asked
    for: two rows of different components are not both inside. Asked rows go in blocks of about ``block`` rows or
    ``block_chars`` characters, and meet all rows of the region whose size allows the similarity, in parts of about ``split``.
    A block's asked rows are held in memory, the others stream past. Work is the asked rows times the rows of
    their region, never all pairs of a group of copies. Texts come from ``keyed`` (:func:`with_key`). No crowded
    region: ``groups`` as given.
    """
    node = F.struct("c1", "c2")
    placed = members.join(groups, node == F.col("node"), "left").select(
        *members.columns, F.coalesce("label", node).alias("component")
    )
    placed = staged(placed, "crowded")
    largest = (
        placed.groupBy("region", "component")
        .agg(F.count("*").alias("n"))
        .groupBy("region")
        .agg(F.count("*").alias("components"), F.max(F.struct("n", "component"))["component"].alias("largest"))
        .where("components > 1")
        .drop("components")
    )
    largest = staged(largest, "divided")
    if largest.isEmpty():
        return groups
    rows = placed.join(largest, "region").select(
        "region", "c1", "c2", "id", "mark", "chars",
        F.col("component.c1").alias("k1"), F.col("component.c2").alias("k2"),
        _level(percent).alias("level"), (F.col("component") != F.col("largest")).alias("asked"),
    )
    rows = staged(rows, "divided-rows")
    nearby = F.explode(F.array(F.col("level") - 1, F.col("level"), F.col("level") + 1)).alias("level")
    tally = rows.groupBy("region", "level").agg(
        F.count("*").alias("n"),
        F.count_if("asked").alias("asked"),
        F.sum(F.when(F.col("asked"), F.col("chars")).otherwise(0)).alias("asked_chars"),
    )
    met = tally.select("region", nearby, "n").groupBy("region", "level").agg(F.sum("n").alias("met"))
    plan = tally.where("asked > 0").join(met, ["region", "level"]).select(
        "region",
        "level",
        F.greatest(F.ceil(F.col("asked") / block), F.ceil(F.col("asked_chars") / block_chars)).alias("blocks"),
        F.ceil(F.col("met") / split).alias("parts"),
    )
    plan = staged(plan, "blocks")
    where = ["region", "level"]
    place = ["c1", "c2", "id", "mark", "k1", "k2"]

    def numbers(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))

    asked = rows.where("asked").join(plan, where)
    asked = asked.select(
        *where, F.pmod(F.xxhash64("c1", "c2"), "blocks").alias("block"), numbers("parts").alias("part"), F.lit(True).alias("asked"), *place
    )
    others = rows.select("region", nearby, *place).join(plan, where)
    others = others.select(
        *where, numbers("blocks").alias("block"), F.pmod(F.xxhash64("c2", "c1"), "parts").alias("part"), F.lit(False).alias("asked"), *place
    )
    both = asked.unionByName(others)
    order = [*where, "block", "part"]
    texts = documents_of(keyed, rows)
    found = (
        join_documents(both, texts, "inner")
        .select(*order, "asked", "c1", "c2", "k1", "k2", "text")
        .repartition(*order)
        .sortWithinPartitions(*order, F.col("asked").desc())
        .mapInArrow(_links(size, percent), LINK)
    )
    found = staged(found, "more-links")
    if found.isEmpty():
        return groups

    def end(x: str) -> Column:
        return F.struct(F.col(f"{x}1").alias("c1"), F.col(f"{x}2").alias("c2")).alias(x)

    stars = groups.select(F.col("node").alias("a"), F.col("label").alias("b"))
    return connected_components(stars.unionByName(found.select(end("a"), end("b"))))
