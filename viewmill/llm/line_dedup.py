"""Lines that many documents share, dropped from all but one of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewmill.llm.common import BLANKS, ascii_lower, join_documents, staged, two_hashes, unpacked, with_key, without_positions

MIN_CHARS, MIN_DOCS = 20, 3


def drop_repeated_lines(
    docs: DataFrame,
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: ``id``, ``row``, ``n_lines``, ``n_dropped``, ``kept_text``.

    A line's key is the line without blanks at its ends and with A-Z in lower case. Keys of at least ``min_chars``
    code points that occur in at least ``min_docs`` documents lose their lines, except in the largest id that has them.

    Lines are exploded as two 64-bit hashes and counted per (hash, document) first, so a line that a third of all
    documents share is spread over tasks until one count per task is left. Positions of dropped lines return to their
    document; the texts are shuffled once, and put together again from the runs of lines between dropped positions.

    A null or empty text is one empty line. Rows that agree in id and text are one document and get the same result;
    rows with one id but other texts count once and keep a line together. A null id counts as no document and keeps
    no line that is dropped elsewhere. An empty table gives an empty table.
    """
    rows = with_key(docs, id_column, text_column)
    split = F.split("text", "\n")
    key = ascii_lower(F.trim(F.col("line"), F.lit(BLANKS)))
    first, second = two_hashes(F.col("key"))
    lines = (
        rows.select("id", "mark", F.posexplode(split).alias("position", "line"))
        .where(F.length("line") >= min_chars)
        .select("id", "mark", "position", key.alias("key"))
        .where(F.length("key") >= min_chars)
        .select("id", "mark", "position", first.alias("h1"), second.alias("h2"))
    )
    frequent = (
        lines.groupBy("h1", "h2")
        .agg(F.countDistinct("id").alias("n"), F.max("id").alias("keeper"))
        .where(F.col("n") >= min_docs)
        .select("h1", "h2", "keeper")
    )
    # Written, so that the join is between two plain tables: Spark can split a line with very many documents there.
    frequent = staged(frequent, "frequent")
    dropped = (
        lines.join(frequent, ["h1", "h2"])
        .where(~F.col("id").eqNullSafe(F.col("keeper")))
        .groupBy("id", "mark")
        .agg(F.sort_array(F.collect_set("position")).alias("dropped"))
    )
    joined = join_documents(rows, dropped).select(
        "id", "row", "text", F.coalesce("dropped", F.array().cast("array<int>")).alias("dropped")
    )
    kept = F.array_join(without_positions(split, F.col("dropped")), "\n")
    return joined.select(
        "id",
        "row",
        F.size(split).cast("long").alias("n_lines"),
        F.size("dropped").cast("long").alias("n_dropped"),
        F.when(F.size("dropped") == 0, F.col("text")).otherwise(kept).alias("kept_text"),
    )


def documents_without_repeated_lines(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with the kept text in place of the text, ``n_chars`` to match; other columns as they are."""
    done = drop_repeated_lines(docs, **options)
    text = options.get("text_column", "text")
    changed = {text: F.when(F.col("row").getField(text).isNotNull(), F.col("kept_text"))}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.length("kept_text")
    return unpacked(done, docs, **changed)
