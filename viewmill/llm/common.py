"""What several operators share: row keys, staged tables, array helpers."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Folders of local sessions that name none, by application.
_LOCAL: dict[str, str] = {}
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Numbers that are broadcast, of 8 bytes each.
SIFT_ROWS = 4_000_000
BLANKS = " \t\n\x0b\f\r"


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``. Where it is unset, a local session gets a folder of its own and any other is refused."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if context.applicationId not in _LOCAL:
        _LOCAL[context.applicationId] = tempfile.mkdtemp(prefix="llm-")
    return _LOCAL[context.applicationId]


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, which cuts its lineage; deleted when the session's JVM ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return spark.read.schema(df.schema).parquet(path)


def column(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def with_key(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Columns ``id``, ``mark``, ``text`` (never null) and ``row`` (the whole input row, whatever its columns are called).

    ``id`` and ``mark`` (a hash of the text) stand for a document: rows that agree in both are the same document twice.
    """
    text = F.coalesce(column(text_column).cast("string"), F.lit(""))
    return docs.select(
        column(id_column).alias("id"),
        F.xxhash64(text).alias("mark"),
        text.alias("text"),
        F.struct(*[column(c) for c in docs.columns]).alias("row"),
    )


def join_documents(a: DataFrame, b: DataFrame, how: str = "left") -> DataFrame:
    """``a`` joined with ``b`` on the keys of :func:`with_key`; a null id equals a null id."""
    other = b.withColumnsRenamed({"id": "_id", "mark": "_mark"})
    on = F.col("id").eqNullSafe(F.col("_id")) & (F.col("mark") == F.col("_mark"))
    return a.join(other, on, how).drop("_id", "_mark")


def documents_of(keyed: DataFrame, rows: DataFrame) -> DataFrame:
    """``id``, ``mark`` and ``text`` of the documents that ``rows`` name by ``id`` and ``mark``, once each.

    Up to :data:`SIFT_ROWS` of them are broadcast as one number each, so that no other text is shuffled; beyond that
    all texts are, once. Two documents with one number only let a text through that no join finds.
    """
    texts = keyed.select("id", "mark", "text")
    number = F.xxhash64("id", "mark")
    wanted = staged(rows.select("id", "mark").distinct(), "wanted")
    if wanted.count() <= SIFT_ROWS:
        numbers = F.broadcast(wanted.select(number.alias("number")).distinct())
        texts = texts.join(numbers, number == F.col("number"), "left_semi")
    else:
        texts = join_documents(texts, wanted, "left_semi")
    return texts.dropDuplicates(["id", "mark"])


def unpacked(keyed: DataFrame, docs: DataFrame, **changed: Column) -> DataFrame:
    """The columns of ``docs`` from ``row``, some of them changed."""
    return keyed.select(
        *[changed.get(c, F.col("row").getField(c)).cast(docs.schema[c].dataType).alias(c) for c in docs.columns]
    )


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, also where ``body`` uses it for every element of an array."""
    return F.transform(F.array(value), body)[0]


def without_positions(items: Column, dropped: Column) -> Column:
    """``items`` less those at the positions in ``dropped`` (ascending, from 0), in linear time."""
    starts = F.concat(F.array(F.lit(0)), F.transform(dropped, lambda p: p + 1))
    return let(
        items,
        lambda all_: F.flatten(
            F.zip_with(starts, F.concat(dropped, F.array(F.size(all_))), lambda s, e: F.slice(all_, s + 1, e - s))
        ),
    )


def ascii_lower(text: Column) -> Column:
    """A-Z, and nothing else, in lower case."""
    return F.translate(text, UPPER, LOWER)


def two_hashes(value: Column) -> list[Column]:
    """128 bits that stand for a value."""
    return [F.xxhash64(value), F.xxhash64(F.lit("second"), value)]


def running(values: Column, combine: Callable[[Column, Column], Column], block: int = 256) -> Column:
    """0 combined with all earlier values, for each element of an array of long; ``combine`` is associative.

    In blocks, as appending copies what is there.
    """
    zero = F.lit(0).cast("long")

    def all_of(a: Column) -> Column:
        start = F.struct(zero.alias("at"), F.array().cast("array<bigint>").alias("out"))
        return F.aggregate(
            a,
            start,
            lambda acc, x: F.struct(combine(acc["at"], x).alias("at"), F.array_append(acc["out"], acc["at"]).alias("out")),
            lambda acc: acc["out"],
        )

    def last_of(a: Column) -> Column:
        return F.aggregate(a, zero, combine)

    def blocks(a: Column) -> Column:
        at = F.sequence(F.lit(0), F.greatest(F.ceil(F.size(a) / block).cast("int") - 1, F.lit(0)))
        return F.transform(at, lambda i: F.slice(a, i * block + 1, block))

    return let(
        values,
        lambda a: let(
            blocks(a),
            lambda cut: F.flatten(
                F.zip_with(
                    F.transform(cut, all_of),
                    all_of(F.transform(cut, last_of)),
                    lambda inner, before: F.transform(inner, lambda x: combine(before, x)),
                )
            ),
        ),
    )


def running_totals(numbers: Column, block: int = 256) -> Column:
    """The sum of all earlier numbers, for each element of an array."""
    return running(numbers, lambda a, b: a + b, block)


def match_spans(text: Column, pattern: str, before: Callable[[Column, Column, Column], Column]) -> Column:
    """All matches of a pattern as (``start``, ``end``, ``match``, ``before``), places in code points.

    Places are running totals of the lengths of matches and of the pieces that splitting leaves between them.
    ``before`` is what that function makes of pieces, matches and the number of the match.
    """

    def spans(pieces: Column, matches: Column) -> Column:
        gaps = F.transform(pieces, F.length)
        return let(
            gaps,
            lambda g: let(
                running_totals(F.zip_with(F.slice(g, 1, F.size(matches)), F.transform(matches, F.length), lambda a, b: (a + b).cast("long"))),
                lambda totals: F.transform(
                    matches,
                    lambda m, i: F.struct(
                        (totals[i] + g[i]).alias("start"),
                        (totals[i] + g[i] + F.length(m)).alias("end"),
                        m.alias("match"),
                        before(pieces, matches, i).alias("before"),
                    ),
                ),
            ),
        )

    return let(
        F.split(text, pattern),
        lambda pieces: let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda m: spans(pieces, m)),
    )
