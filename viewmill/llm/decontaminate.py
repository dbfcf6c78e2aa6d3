"""Documents that contain passages of benchmark items: a prefix-filtered set join with exact confirmation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from viewmill.llm.common import ascii_lower, join_documents, staged, unpacked, with_key

WINDOW, SHINGLE = 13, 3
#: Shingles are broadcast as 64-bit hashes; so many take about 64 MB.
BROADCAST_SHINGLES = 2_000_000
_SEPARATORS = "".join(map(chr, [*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))


def benchmark_words(text: Column) -> Column:
    """Runs of 0-9, a-z (A-Z in lower case) and anything beyond ASCII."""
    inner = F.trim(ascii_lower(F.coalesce(text.cast("string"), F.lit(""))), F.lit(_SEPARATORS))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(
        F.split(inner, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    )


def _shingle(words: Column, at: Column, length: int) -> Column:
    """Hash of ``length`` words from position ``at``; null where they would leave the text."""
    hashed = F.xxhash64(F.lit(length), *[F.get(words, at + i) for i in range(length)])
    return F.when(at + length <= F.size(words), hashed)


def _windows(benchmark: DataFrame, id_column: str, text_column: str, window: int) -> DataFrame:
    """Distinct (``passage``, ``item``): passages of ``window`` words, or the whole of a shorter item."""
    items = benchmark.select(
        F.col(id_column).cast("string").alias("item"), benchmark_words(F.col(text_column)).alias("words")
    ).where(F.size("words") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - window, F.lit(0)))
    return (
        items.select("item", "words", F.explode(starts).alias("start"))
        .select("item", F.slice("words", F.col("start") + 1, window).alias("passage"))
        .distinct()
    )


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    broadcast_shingles: int = BROADCAST_SHINGLES,
) -> DataFrame:
    """One row per row of ``docs``: ``id``, ``mark``, ``n_words``, ``n_hit``, ``n_items``, ``items`` and ``contaminated``.

    Every passage is the set of its shingles of three words (all of its words if it is shorter). One pass over the
    documents finds the positions whose shingle is in any passage, with the words around them, and the number of words.
    Shingles are ordered by how often they occur there. A passage occurs only where its rarest shingle does, so that
    one is its whole necessary prefix; positions are joined with passages on it, kept if the passage fits between the
    ends of the document at that offset (positional and length bound), and confirmed word by word.

    Shingle hashes are broadcast up to ``broadcast_shingles``; beyond that the join shuffles. A word that many
    passages or documents share is a hot key only for positions that the benchmark has as well.

    Null or empty texts have no words and are clean; items without words are left out; a null item id leaves its hits
    but names no item. Repeated rows get the same result each. Empty tables give an empty or a clean result.
    """
    passages = staged(_windows(benchmark, item_column, item_text_column, window), "passages")
    size = F.least(F.size("passage"), F.lit(SHINGLE))
    offsets = passages.select("passage").distinct().select(
        "passage", size.alias("length"), F.explode(F.sequence(F.lit(0), F.size("passage") - size)).alias("offset")
    )
    hashed = F.coalesce(
        *[F.when(F.col("length") == n, _shingle(F.col("passage"), F.col("offset"), n)) for n in range(1, SHINGLE + 1)]
    )
    offsets = offsets.select("passage", "offset", "length", hashed.alias("shingle"))
    shingles = offsets.select("shingle", "length").distinct()
    found = {r["length"]: r["n"] for r in shingles.groupBy("length").agg(F.count("*").alias("n")).collect()}
    small = sum(found.values()) <= broadcast_shingles
    wanted = shingles.select(F.col("shingle").alias("wanted"))

    keyed = with_key(docs, id_column, text_column)
    words, at = F.col("words"), F.col("position")
    low = F.greatest(at - (window - 1), F.lit(0))
    around = F.slice(words, low + 1, 2 * window - 1).alias("around")
    # One more position than there are words: its row carries the number of words and never has a shingle.
    positions = keyed.select("id", "mark", benchmark_words(F.col("text")).alias("words")).select(
        "id", "mark", "words", F.explode(F.sequence(F.lit(0), F.size("words"))).alias("position")
    )
    each = [_shingle(words, at, n) for n in sorted(found)] or [F.lit(None).cast("long")]
    here = positions.withColumn("shingle", each[0] if len(each) == 1 else F.explode(F.array(*each)))
    kept = [F.col("id"), F.col("mark"), at, F.size("words").alias("n_words"), F.col("shingle")]
    if small:
        here = here.join(F.broadcast(wanted), F.col("shingle") == F.col("wanted"), "left")
    else:
        here = here.select(*kept, around).join(wanted, F.col("shingle") == F.col("wanted"), "left")
        kept, around = [F.col(c) for c in ("id", "mark", "position", "n_words", "shingle")], F.col("around")
    last = at == (F.size("words") if small else F.col("n_words"))
    here = here.where(F.col("wanted").isNotNull() | last).select(
        *kept, F.when(F.col("wanted").isNotNull(), around).alias("around")
    )
    # With several shingle lengths the last position comes once for each; only the first counts.
    matches = staged(here, "matches")
    lengths = matches.where(F.col("around").isNull())
    if len(each) > 1:
        lengths = lengths.groupBy("id", "mark", "n_words").agg((F.count("*") / len(each)).cast("int").alias("times"))
        lengths = lengths.select("id", "mark", "n_words", F.explode(F.sequence(F.lit(1), F.col("times"))))
    matches = matches.where(F.col("around").isNotNull())

    rarity = matches.groupBy("shingle").agg(F.count("*").alias("times"))
    prefix = (
        offsets.join(rarity, "shingle")
        .groupBy("passage")
        .agg(F.min(F.struct("times", "shingle", "offset")).alias("rarest"))
        .select("passage", "rarest.shingle", "rarest.offset")
    )
    start = at - F.col("offset")
    hits = (
        matches.join(prefix, "shingle")
        .select("id", "mark", "n_words", "around", low.alias("low"), start.alias("start"), "passage")
        .where((F.col("start") >= 0) & (F.col("start") + F.size("passage") <= F.col("n_words")))
        .where(F.slice("around", F.col("start") - F.col("low") + 1, F.size("passage")) == F.col("passage"))
        .select("id", "mark", "start", "passage")
        .distinct()
    )
    hits = staged(hits, "hits")
    end = F.col("start") + F.size("passage")
    order = W.partitionBy("id", "mark").orderBy("start", "passage")
    before = F.max("end").over(order.rowsBetween(W.unboundedPreceding, -1))
    fresh = F.greatest(F.col("end") - F.greatest(F.col("start"), F.coalesce("before", "start")), F.lit(0))
    covered = (
        hits.withColumn("end", end)
        .withColumn("before", before)
        .groupBy("id", "mark")
        .agg(F.sum(fresh).alias("n_hit"))
    )
    items = (
        hits.join(passages.where(F.col("item").isNotNull()), "passage")
        .groupBy("id", "mark")
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
    )
    hit = join_documents(covered, items)
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    names = F.coalesce("items", F.array().cast("array<string>"))
    return join_documents(lengths, hit).select(
        "id",
        "mark",
        F.col("n_words").cast("long").alias("n_words"),
        n_hit.alias("n_hit"),
        F.size(names).cast("long").alias("n_items"),
        names.alias("items"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without contaminated documents."""
    bad = find_contamination(docs, benchmark, **options).where("contaminated").select("id", "mark").distinct()
    keyed = with_key(docs, options.get("id_column", "doc_id"), options.get("text_column", "text"))
    return unpacked(join_documents(keyed, bad, "left_anti"), docs)
