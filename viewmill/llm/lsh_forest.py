"""Near-duplicate documents by an LSH forest over MinHash signatures, confirmed on full shingle sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewmill.llm.common import documents_of, join_documents, staged, unpacked, with_key
from viewmill.llm.components import connected_components
from viewmill.llm.crowded import completed_components
from viewmill.llm.words import mix, shingle_sets

SHINGLE, PERCENT = 5, 85
#: Orders of the forest; values of a label; values that neighbours share at least. A pair with similarity 0.85
#: shares 4 of 4 values in none of 16 orders with probability 0.000007.
TREES, DEPTH, LEAST = 16, 8, 4
#: Rows of a region above which its prefix gets one value longer, and rows compared at a time.
REGION = 128
#: A region of full depth with more rows than this is dealt to several tasks, each with its first row.
SPLIT = 4096
#: Characters of text compared at a time, if the region has more than two rows.
REGION_CHARS = 16 << 20


def _signatures(size: int, values: int):
    factors = (mix(np.arange(values, dtype=np.uint64), 7) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    shifts = (mix(np.arange(values, dtype=np.uint64), 8) >> np.uint64(32)).astype(np.uint32)

    def signature(found: np.ndarray) -> bytes | None:
        if not len(found):
            return None
        least = np.full(values, 0xFFFFFFFF, dtype=np.uint32)
        for i in range(0, len(found), 4096):
            part = (found[i : i + 4096] >> np.uint64(32)).astype(np.uint32)[:, None]
            least = np.minimum(least, (part * factors + shifts).min(axis=0))
        return least.astype(">u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, a, b, signs = [], [], [], []
            chars = pc.utf8_length(batch["text"]).cast(pa.int64())
            for found in shingle_sets(batch["text"], size):
                n.append(len(found))
                a.append(int(mix(found, 1).sum(dtype=np.uint64)))
                b.append(int(mix(found, 2).sum(dtype=np.uint64)))
                signs.append(signature(found))
            numbers = [pa.array(np.array(x, dtype=np.uint64).view(np.int64)) for x in (a, b)]
            yield pa.RecordBatch.from_arrays(
                [batch["id"], batch["mark"], chars, pa.array(n, pa.int64()), *numbers, pa.array(signs, pa.binary())],
                ["id", "mark", "chars", "n_shingles", "c1", "c2", "signature"],
            )

    return run


class _Forest:
    """Union-find over the rows of one comparison."""

    def __init__(self, n: int):
        self.above = list(range(n))

    def top(self, i: int) -> int:
        while self.above[i] != i:
            self.above[i] = self.above[self.above[i]]
            i = self.above[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.top(i), self.top(j)
        self.above[max(i, j)] = min(i, j)
        return i != j


def _intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, from products of 0/1 blocks over the shingles that two sets have at least."""
    if len(sets) == 2:
        n = len(np.intersect1d(*sets, assume_unique=True))
        return np.array([[len(sets[0]), n], [n, len(sets[1])]], dtype=np.float64)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, which, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = np.cumsum(times > 1) - 1
    chosen = times[which] > 1
    owner, which = owner[chosen], shared[which[chosen]]
    order = np.argsort(which, kind="stable")
    owner, which = owner[order], which[order]
    out = np.zeros((len(sets), len(sets)), dtype=np.float64)
    width = 8192
    for low in range(0, int(which[-1]) + 1 if len(which) else 0, width):
        a, b = np.searchsorted(which, [low, low + width])
        block = np.zeros((len(sets), width), dtype=np.float32)
        block[owner[a:b], which[a:b] - low] = 1
        out += block @ block.T
    return out


def _links(rows: list[tuple], size: int, percent: int) -> list[tuple[int, int, int, int]]:
    """Links that connect what is connected among rows of (c1, c2, text)."""
    sets = list(shingle_sets(pa.array([r[2] for r in rows], pa.string()), size))
    both = _intersections(sets)
    n = np.array([len(s) for s in sets], dtype=np.float64)
    near = 100 * both >= percent * (n[:, None] + n[None, :] - both)
    forest, out = _Forest(len(rows)), []
    for i, j in zip(*np.nonzero(np.triu(near, 1)), strict=True):
        if rows[i][:2] != rows[j][:2] and forest.join(int(i), int(j)):
            out.append((*rows[i][:2], *rows[j][:2]))
    return out


def _compare(size: int, percent: int, most: int, most_chars: int):
    """Compares the rows of each region, which come together and in the order of their labels."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple] = []
        region, rows, weight = None, [], 0
        for batch in batches:
            columns = [batch[c].to_pylist() for c in ("region", "part", "c1", "c2", "text")]
            for key, part, c1, c2, text in zip(*columns, strict=True):
                if (key, part) != region:
                    if len(rows) > 1:
                        found += _links(rows, size, percent)
                    region, rows, weight = (key, part), [], 0
                rows.append((c1, c2, text))
                weight += len(text)
                if len(rows) > most or (weight > most_chars and len(rows) > 2):
                    found += _links(rows, size, percent)
                    # The first row of the region meets all others; neighbours in the order meet each other.
                    rows = [rows[0], rows[-1]]
                    weight = sum(len(r[2]) for r in rows)
            yield _linked(found)
            found = []
        if len(rows) > 1:
            found += _links(rows, size, percent)
        yield _linked(found)

    return run


def _linked(found: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*found, strict=True)) or [[], [], [], []]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a1", "a2", "b1", "b2"])


def _crowded(regions: DataFrame, region: int) -> DataFrame:
    """Rows of the regions at the shortest prefix that are not compared whole; of regions with the same rows those of one."""
    rows = regions.where((F.col("n") > region) | (F.col("all_chars") > REGION_CHARS))
    sets = [F.bit_xor(F.xxhash64("c1", "c2")).alias("s1"), F.bit_xor(F.xxhash64("c2", "c1")).alias("s2")]
    once = rows.groupBy("region", "n").agg(*sets).groupBy("n", "s1", "s2").agg(F.min("region").alias("region"))
    once = staged(once.select("region"), "crowded-regions")
    return rows.join(once, "region").select("region", "c1", "c2", "id", "mark", "n_shingles", "chars")


def near_duplicate_groups(
    docs: DataFrame,
    percent: int = PERCENT,
    size: int = SHINGLE,
    trees: int = TREES,
    depth: int = DEPTH,
    least: int = LEAST,
    region: int = REGION,
    split: int = SPLIT,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: ``id``, ``mark``, ``n_shingles``, ``component_id``, ``kept``.

    A document is the set of its shingles of ``size`` words (A-Z lower-cased). Documents link at ``percent`` per cent
    similarity; a component's id is the smallest id reachable, and ``kept`` marks the document with that id.

    Documents with equal sets are one class, folded before anything else. Every class gets ``trees`` labels of
    ``depth`` MinHash values; each label is its place in one sorted order. Classes that share a prefix of ``least``
    values are candidates. Where more than ``region`` share it, the prefix grows value by value, up to the whole
    label: depth adapts to each region. A region's rows lie together in label order; so many at a time are compared on
    their full shingle sets, neighbours staying together and the region's first row meeting all. Comparing gives
    only the links that connect, never all pairs. Regions of several orders that hold the same classes are compared once. A region of whole labels with more than ``split`` rows is dealt
    to several tasks, its first class to all of them. What that leaves in different components of one region of
    ``least`` values, whether longer prefixes parted it or not, is then compared too (see
    :mod:`viewmill.llm.crowded`), so a region's size costs no link.

    Pairs that share ``least`` values in no order are not candidates: 0.000007 of pairs at the threshold.

    Null and empty texts have no shingles and are linked with nothing, equal ones neither: each is its own component.
    Null ids come last: a component of null ids only has a null id, and its documents are all kept. Repeated rows
    get the same result. An empty table gives an empty table.
    """
    keyed = with_key(docs, id_column, text_column)
    kind = keyed.schema["id"].dataType.simpleString()
    signed = staged(
        keyed.select("id", "mark", "text").mapInArrow(
            _signatures(size, trees * depth),
            f"id {kind}, mark long, chars long, n_shingles long, c1 long, c2 long, signature binary",
        ),
        "signatures",
    )
    classes = (
        signed.where("n_shingles > 0")
        .groupBy("c1", "c2")
        .agg(F.min(F.struct("id", "mark", "chars")).alias("at"), F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature"))
    )
    label = F.substring(F.col("signature"), F.col("tree") * (4 * depth) + 1, F.lit(4 * depth))
    labels = classes.select(
        "c1", "c2", "n_shingles", "at", "signature", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree")
    ).select("c1", "c2", "n_shingles", "at", "tree", label.alias("label"))

    def prefix(n: int):
        return F.xxhash64("tree", F.substring("label", 1, 4 * n))

    labels = labels.select("c1", "c2", "n_shingles", "at.*", "tree", "label", prefix(least).alias("region"))

    def shared(rows: DataFrame) -> DataFrame:
        """Regions of more than one row. Of regions that hold the same rows and are compared whole, the one of one tree is enough."""
        sets = [F.bit_xor(F.xxhash64("c1", "c2")).alias("s1"), F.bit_xor(F.xxhash64("c2", "c1")).alias("s2")]
        tally = rows.groupBy("region").agg(F.count("*").alias("n"), F.sum("chars").alias("all_chars"), *sets).where("n > 1")
        whole = (F.col("n") <= region) & (F.col("all_chars") <= REGION_CHARS)
        tally = tally.withColumn("s1", F.when(whole, F.col("s1")).otherwise(F.col("region")))
        once = tally.groupBy("n", "all_chars", "s1", "s2").agg(F.min("region").alias("region"))
        # Written, so that joins are between two plain tables: Spark can split a crowded region there.
        return staged(once.select("region", "n", "all_chars"), "shared")

    open_ = staged(labels.join(shared(labels), "region"), "regions")
    crowded = _crowded(open_, region)
    done = []
    for n in range(least + 1, depth + 1):
        done.append(open_.where(F.col("n") <= region))
        open_ = open_.where(F.col("n") > region).drop("n", "all_chars").withColumn("region", prefix(n))
        open_ = open_.join(shared(open_), "region")
    members = open_
    for part in done:
        members = members.unionByName(part)
    parts = F.ceil(F.col("n") / F.lit(split))
    members = members.withColumn("part", F.pmod(F.xxhash64("c1", "c2"), parts))
    members = staged(members.select("region", "part", "n", "label", "c1", "c2", "id", "mark"), "members")
    firsts = (
        members.where(F.col("n") > split)
        .groupBy("region", "n")
        .agg(F.min(F.struct("label", "c1", "c2", "id", "mark")).alias("f"))
        .select("region", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("part"), "n", "f.*")
    )
    members = members.unionByName(firsts).drop("n").distinct()
    texts = documents_of(keyed, members)
    found = (
        join_documents(members, texts, "inner")
        .select("region", "part", "label", "c1", "c2", "text")
        .repartition("region", "part")
        .sortWithinPartitions("region", "part", "label", "c1", "c2")
        .mapInArrow(_compare(size, percent, region, REGION_CHARS), "a1 long, a2 long, b1 long, b2 long")
    )
    edges = staged(
        found.select(F.struct(F.col("a1").alias("c1"), F.col("a2").alias("c2")).alias("a"), F.struct(F.col("b1").alias("c1"), F.col("b2").alias("c2")).alias("b")),
        "links",
    )
    groups = connected_components(edges)
    if not crowded.isEmpty():
        groups = completed_components(crowded, groups, keyed, percent, size, region, REGION_CHARS, split)
    ids = signed.where("n_shingles > 0").groupBy("c1", "c2").agg(F.min("id").alias("least_id"))
    labelled = ids.join(groups, F.struct("c1", "c2") == F.col("node"), "left").select(
        "c1", "c2", "least_id", F.coalesce("label", F.struct("c1", "c2")).alias("label")
    )
    smallest = labelled.groupBy("label").agg(F.min("least_id").alias("component"))
    # Only classes that are linked need another id than their own.
    linked = labelled.join(smallest, "label").select(
        F.col("c1").alias("d1"), F.col("c2").alias("d2"), "component"
    )
    joined = signed.join(
        linked, (F.col("n_shingles") > 0) & (F.col("c1") == F.col("d1")) & (F.col("c2") == F.col("d2")), "left"
    )
    component = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("id"))
    return joined.select(
        "id", "mark", "n_shingles", component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept")
    )


def one_of_each_group(docs: DataFrame, **options) -> DataFrame:
    """``docs`` less all near duplicates but one of each group; of rows that agree in id and text one stays."""
    groups = near_duplicate_groups(docs, **options)
    copies = groups.where(~F.col("kept")).select("id", "mark").distinct()
    keyed = with_key(docs, options.get("id_column", "doc_id"), options.get("text_column", "text"))
    kept = join_documents(keyed, copies, "left_anti")
    if not groups.groupBy("id", "mark").count().where("count > 1").isEmpty():
        kept = kept.dropDuplicates(["id", "mark"])
    return unpacked(kept, docs)
