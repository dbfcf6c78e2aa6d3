"""Importance resampling towards a target: hashed n-gram weights, Gumbel keys, and a cutoff found in a bracket.

A document's weight is the sum of the gains of its hashed features, read from one array. Keys are weights plus Gumbel
noise, and the highest are drawn. Where the last drawn one lies is not found by sorting all: a quantile sketch
proposes a bracket, exact counts outside it tell whether it holds the cutoff, and only the bracket is sorted.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from viewmill.llm.common import LOWER, UPPER, staged, with_key

BUCKETS = 10_000
LONGEST = 3
LEAST_WORDS = 20
PERCENT = 5
SEED = "42"
#: The sketch errs by about one in this many ranks; a bracket starts with twice that on either side.
SKETCH = 10_000

# Bytes of words: digits, letters in lower case and whatever is not ASCII; all others part words.
_WORDS = bytes(
    ord(LOWER[UPPER.index(chr(b))]) if chr(b) in UPPER else b if b > 127 or chr(b).isalnum() else 32 for b in range(256)
)


def hashed_features(text: str, buckets: int = BUCKETS, longest: int = LONGEST) -> tuple[int, np.ndarray]:
    """The number of words, and the bucket of every run of 1 to ``longest`` words.

    A bucket is the CRC-32 of the words joined by one space, modulo ``buckets``. The CRC of a run goes on from that of
    the run without its last word.
    """
    words = text.encode().translate(_WORDS).split()
    codes = list(map(crc32, words))
    spaced = [b" " + w for w in words]
    found = [codes]
    for n in range(1, min(longest, len(words))):
        codes = list(map(crc32, spaced[n:], codes))
        found.append(codes)
    size = sum(map(len, found))
    return len(words), np.fromiter(chain.from_iterable(found), dtype=np.int64, count=size) % buckets


def bucket_counts(texts: DataFrame, text_column: str = "text", buckets: int = BUCKETS, longest: int = LONGEST) -> np.ndarray:
    """How many features of all texts fall into each bucket; null counts as empty.

    Counted per task first. ``buckets`` numbers reach the driver, however many texts there are.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for text in batch["text"]:
                counts += np.bincount(hashed_features(text.as_py(), buckets, longest)[1], minlength=buckets)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(counts[used], pa.int64())], ["bucket", "n"])

    text = F.coalesce(F.col("`" + text_column.replace("`", "``") + "`").cast("string"), F.lit("")).alias("text")
    counted = texts.select(text).mapInArrow(count, "bucket int, n long")
    total = np.zeros(buckets, dtype=np.int64)
    for bucket, n in counted.groupBy("bucket").agg(F.sum("n")).collect():
        total[bucket] = n
    return total


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket floor(1000 ln of how much likelier a feature of the target is to fall there), counts raised by one."""
    n, all_source, all_target = len(source), float(source.sum()), float(target.sum())
    return np.array(
        [
            math.floor(1000 * math.log((t + 1.0) * (all_source + n) / ((s + 1.0) * (all_target + n))))
            for s, t in zip(source.tolist(), target.tolist(), strict=True)
        ],
        dtype=np.int64,
    )


def scored_documents(docs: DataFrame, gains: np.ndarray, longest: int = LONGEST, seed: str = SEED) -> DataFrame:
    """``id``, ``n_words``, ``n_features``, ``weight``, ``score`` of keyed documents.

    Gumbel noise comes from the first 32 bits of the SHA-256 of ``seed:id``, so reruns agree; a null id is written empty.
    """

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch["text"]:
                n_words, features = hashed_features(text.as_py(), len(gains), longest)
                rows.append((n_words, len(features), int(gains[features].sum())))
            columns = [pa.array([r[i] for r in rows], pa.int64()) for i in range(3)]
            yield pa.RecordBatch.from_arrays([batch["id"], *columns], ["id", "n_words", "n_features", "weight"])

    kind = docs.schema["id"].dataType.simpleString()
    weighed = docs.select("id", "text").mapInArrow(weigh, f"id {kind}, n_words long, n_features long, weight long")
    label = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    drawn = F.conv(F.substring(F.sha2(label, 256), 1, 8), 16, 10).cast("double")
    gumbel = F.floor(-1000 * F.log(-F.log((drawn + 0.5) / float(2**32))))
    return weighed.withColumn("score", (F.col("weight") + gumbel).cast("long"))


def _order() -> list:
    """Highest score first, then the smaller id; the rest only makes the order of equal ids a fixed one."""
    return [F.desc("score"), F.asc_nulls_last("id"), F.asc("n_features"), F.asc("weight")]


def numbered(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` with their ``place`` (1, 2, 3, …) in the order of drawing.

    Rows are dealt out by ranges of the order and written with the number of their range, so that a task that is repeated
    finds the same ranges. A place is that within the range plus the sizes of the ranges before it, one number each.
    """
    ranged = staged(rows.repartitionByRange(*_order()).withColumn("_range", F.spark_partition_id()), name)
    sizes = dict(sorted(ranged.groupBy("_range").count().collect()))
    before, offsets = 0, []
    for part, size in sizes.items():
        offsets.append((part, before))
        before += size
    table = rows.sparkSession.createDataFrame(offsets, "_of int, _before long")
    inside = F.row_number().over(W.partitionBy("_range").orderBy(*_order()))
    placed = ranged.withColumn("_inside", inside).join(F.broadcast(table), F.col("_range") == F.col("_of"))
    return placed.select(*rows.columns, (F.col("_before") + F.col("_inside")).cast("long").alias("place"))


def score_bracket(scores: DataFrame, wanted: int, sketch: int = SKETCH) -> tuple[int, int, int]:
    """(low, high, above): the ``wanted``-th highest score lies between low and high, and ``above`` scores exceed high.

    Bounds are proposed by a quantile sketch. Scores above them are counted exactly: if too many lie above, or too few
    above and within, the bracket is widened eightfold, at last to all scores.
    """
    total = scores.count()
    margin = 2 / sketch
    while True:
        at = 1 - wanted / total
        chances = [max(at - margin, 0.0), min(at + margin, 1.0)]
        if chances == [0.0, 1.0]:
            low, high = scores.agg(F.min("score"), F.max("score")).first()
        else:
            low, high = scores.agg(F.percentile_approx("score", chances, sketch)).first()[0]
        count = F.count(F.when(F.col("score") > high, 1)), F.count(F.when(F.col("score") >= low, 1))
        above, reached = scores.agg(*count).first()
        if above < wanted <= reached:
            return low, high, above
        margin *= 8


def resample_documents(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    buckets: int = BUCKETS,
    longest: int = LONGEST,
    seed: str = SEED,
    sketch: int = SKETCH,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: ``id``, ``n_words``, ``n_features``, ``weight``, ``score``, ``rank``.

    Of the documents with at least ``least_words`` words, ``percent`` in a hundred (rounded down) are drawn, those of
    highest score; they have their rank, others null. Words are runs of digits, letters and all that is not ASCII, with
    A-Z in lower case. Features are all runs of 1 to ``longest`` words, in ``buckets`` hashed buckets; the gains of
    buckets compare ``docs`` with the ``text`` of ``target``. Texts are read twice and shuffled never; only ids and four
    numbers per document are written, and only the bracket of the cutoff and what is drawn are sorted, in ranges.

    Null and empty texts have no features, weight 0 and are not drawn. Very long texts are counted whole. Ties of the
    score go to the smaller id, a null id last. Repeated rows are drawn one after the other. Other columns are not read
    and may have any name. An empty ``docs`` gives an empty table; without target text all buckets count as equally likely.
    """
    keyed = with_key(docs, id_column, text_column)
    gains = bucket_gains(
        bucket_counts(keyed, "text", buckets, longest), bucket_counts(target, "text", buckets, longest)
    )
    scored = staged(scored_documents(keyed, gains, longest, seed), "scored")
    eligible = scored.where(F.col("n_words") >= least_words)
    wanted = percent * eligible.count() // 100
    none = F.lit(None).cast("long").alias("rank")
    if wanted == 0:
        return scored.select("*", none)
    low, high, above = score_bracket(eligible, wanted, sketch)
    bracket = numbered(eligible.where(F.col("score").between(low, high)), "bracket")
    # Rows before the cutoff are drawn. Rows equal to it in every column are told apart by their place only.
    last = bracket.where(F.col("place") == wanted - above).select("score", "id").first()
    reaches = F.col("score") > last["score"]
    at = F.lit(last["id"]).cast(scored.schema["id"].dataType)
    earlier = F.lit(True) if last["id"] is None else F.coalesce(F.col("id") <= at, F.lit(False))
    reaches = (F.col("n_words") >= least_words) & (reaches | ((F.col("score") == last["score"]) & earlier))
    drawn = numbered(scored.where(reaches), "drawn")
    ranked = drawn.select(*scored.columns, F.when(F.col("place") <= wanted, F.col("place")).alias("rank"))
    return ranked.unionByName(scored.where(~reaches).select("*", none))
