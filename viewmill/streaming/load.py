"""Structured Streaming job that keeps the star up to date."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import replace

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from viewmill.operators.enrich import enrich
from viewmill.operators.geo import ranges_fit_broadcast
from viewmill.plans.star import LoadOptions, load_enriched
from viewmill.schemas import PRODUCT_VIEW
from viewmill.sources.events import views_from_records
from viewmill.sources.store import StarStore

DEFAULT_TRIGGER = {"processingTime": "10 seconds"}

# Where Spark tells a micro-batch the id of its streaming query.
QUERY_ID = "sql.streaming.queryId"


def load_id_of(run_id: str, batch_id: int) -> str:
    """The name under which a micro-batch is stored; the same one when it is delivered again."""
    return f"{run_id}-{batch_id:09d}"


def without_redelivered(views: DataFrame, remember: str) -> DataFrame:
    """Views of a stream less those delivered before within the time ``remember``, whole events alike in all fields.

    Ids and contents seen are keyed state in the checkpoint, spread over executors by key and forgotten ``remember`` after
    they came, so its size follows the traffic and not history. Events with the same id and other contents pass: which of
    them counts is for the load to say, as is whatever comes back later than that.
    """
    known = F.md5(F.to_json(F.struct(*[F.col(c) for c in views.columns])))
    return (
        views.withColumns({"_arrived": F.current_timestamp(), "_known": known})
        .withWatermark("_arrived", remember)
        .dropDuplicatesWithinWatermark(["view_id", "_known"])
        .drop("_arrived", "_known")
    )


def start_star_stream(
    store: StarStore,
    records: DataFrame,
    checkpoint: str,
    ranges: DataFrame,
    internal_keywords: Iterable[str],
    trigger: Mapping[str, object] = DEFAULT_TRIGGER,
    options: LoadOptions = LoadOptions(),
    kind: str = PRODUCT_VIEW,
    remember: str | None = None,
) -> StreamingQuery:
    """Start loading ``records`` (a stream with a ``value`` column) into the star.

    ``remember``, such as ``"2 hours"``, drops what is delivered again within that time before a batch is made of it (see
    :func:`without_redelivered`); the load finds the rest among what is stored. Worth its shuffle where much is
    delivered twice. Not to be changed for a checkpoint that exists.

    While the range table can be broadcast, enrichment is part of the streaming plan, which is built
    once. A bigger table is joined within each micro-batch, since that join counts the views first.
    Offsets are kept under ``checkpoint``. After a crash the last batch is delivered again with the same id: what an
    attempt that failed has written is replaced, and of one that was committed only the offsets are missing.

    Loads are named after the query id, which Spark keeps in the checkpoint: with a new checkpoint
    batch ids restart, but never under the name of an older load. End a job with
    ``query.awaitTermination()``.
    """
    keywords = tuple(internal_keywords)
    broadcast = options.broadcast_ranges
    if broadcast is None:
        broadcast = ranges_fit_broadcast(ranges)
    options = replace(options, broadcast_ranges=broadcast)
    # Read once for all batches; a lost executor's part is read again.
    lookup = ranges.persist(StorageLevel.MEMORY_AND_DISK)
    stream = views_from_records(records, kind)
    if remember:
        stream = without_redelivered(stream, remember)
    if broadcast:
        stream = enrich(stream, lookup, keywords, broadcast)

    def load(batch: DataFrame, batch_id: int) -> None:
        query_id = batch.sparkSession.sparkContext.getLocalProperty(QUERY_ID)
        if not query_id:
            raise RuntimeError("a micro-batch without a query id: its load would have the name of another stream's")
        target = StarStore(batch.sparkSession, store.root)
        enriched = batch if broadcast else enrich(batch, lookup, keywords, broadcast)
        load_enriched(target, enriched, load_id_of(query_id, batch_id), options)

    return (
        stream.writeStream.outputMode("append")
        .foreachBatch(load)
        .trigger(**trigger)
        .option("checkpointLocation", checkpoint)
        .start()
    )
