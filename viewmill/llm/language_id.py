"""Language by compression: the language whose dictionary makes a text smallest."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewmill.llm.common import column

#: Bounds of the sample that dictionaries are made of: texts looked for in each language, characters used of each,
#: bytes of one dictionary. Counts, and all predictions, are over whole tables and whole texts.
SAMPLE_ROWS, SAMPLE_CHARS, DICTIONARY_BYTES = 1200, 100, 110_000
#: Texts are compressed in blocks, so that the dictionary and not the text's own past decides.
BLOCK_BYTES, LEVEL = 4096, 6
#: A prediction is rejected if the second language needs less than this share more bytes.
MIN_MARGIN = 0.001
#: A language with fewer pieces keeps them all: half of them are too few to judge the others by.
FEW_PIECES = 20
UNKNOWN = "und"


@dataclass(frozen=True)
class LanguageModel:
    """A raw-content dictionary for each language; bounded by languages times ``DICTIONARY_BYTES``."""

    dictionaries: dict[str, bytes]
    block_bytes: int = BLOCK_BYTES
    level: int = LEVEL


def letters(text: Column) -> Column:
    """Lower-case letters, each run of anything else as one blank: what tells languages apart."""
    return F.lower(F.regexp_replace(text, r"[^\p{L}\p{M}]+", " "))


def _has_letter(text: Column) -> Column:
    return text.rlike(r"\p{L}")


def fit_languages(
    rows: DataFrame,
    sample_rows: int = SAMPLE_ROWS,
    sample_chars: int = SAMPLE_CHARS,
    dictionary_bytes: int = DICTIONARY_BYTES,
) -> LanguageModel:
    """Dictionaries from ``text`` and ``lang`` of labelled rows (others are left out).

    Different texts are counted per language over the whole table (by a sketch, to a few percent), and each language is
    sampled by a hash of the text at the rate that gives about ``sample_rows`` of them, however often each is repeated: a
    language of few texts gives all of them. Short pieces of many rows are used: a long one would favour its own
    copies. Wrong labels are weeded out: each half of the pieces is classified by dictionaries of the other half, and
    only pieces that agree with their label stay. No labelled rows give a model without languages.
    """
    labelled = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
    labelled = labelled.where(_has_letter(F.col("text")))
    texts = F.approx_count_distinct(F.xxhash64("text"), 0.02)
    counts = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(texts.alias("n")).collect()}
    if not counts:
        return LanguageModel({})
    rates = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, sample_rows / max(n, 1)))])
    chance = F.pmod(F.xxhash64("text", F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    sample = (
        labelled.where(chance < F.get(F.array(rates[F.col("lang")]), F.lit(0)))
        .select("lang", F.substring(F.trim(letters(F.col("text"))), 1, sample_chars).alias("piece"))
        .distinct()
        .collect()
    )
    pieces: dict[str, list[str]] = {lang: [] for lang in counts}
    for row in sorted(sample, key=lambda r: (r["lang"], r["piece"])):
        pieces[row["lang"]].append(row["piece"])
    halves = [{lang: p[n::2] for lang, p in pieces.items()} for n in (0, 1)]
    judges = [_compressors(_dictionaries(half, dictionary_bytes), LEVEL) for half in halves]
    kept: dict[str, list[str]] = {}
    for half, judge in zip(halves, reversed(judges), strict=True):
        for lang, some in half.items():
            kept[lang] = kept.get(lang, []) + [p for p in some if not judge or _ranked(p, judge, BLOCK_BYTES)[0][1] == lang]
    # A language whose pieces all look like another one's keeps them: it is still a language to learn.
    weeded = {lang: p if p and len(pieces[lang]) >= FEW_PIECES else pieces[lang] for lang, p in kept.items()}
    return LanguageModel(_dictionaries(weeded, dictionary_bytes))


def _dictionaries(pieces: dict[str, list[str]], size: int) -> dict[str, bytes]:
    return {lang: "\n".join(p).encode()[-size:] for lang, p in sorted(pieces.items()) if p}


def _compressors(dictionaries: dict[str, bytes], level: int) -> dict[str, zstandard.ZstdCompressor]:
    tools = {}
    for lang, content in dictionaries.items():
        words = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        words.precompute_compress(level=level)
        tools[lang] = zstandard.ZstdCompressor(dict_data=words, level=level, write_content_size=False, write_dict_id=False)
    return tools


def _ranked(text: str, tools: dict[str, zstandard.ZstdCompressor], block: int) -> list[tuple[int, str]]:
    """(bytes, language), fewest bytes first."""
    data = text.encode()
    blocks = [data[i : i + block] for i in range(0, len(data), block)]
    return sorted((sum(len(tool.compress(b)) for b in blocks), lang) for lang, tool in tools.items())


def _classifier(model: LanguageModel):
    def classify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = _compressors(model.dictionaries, model.level)
        for batch in batches:
            pred, score, margin = [], [], []
            for text, usable in zip(batch["text"].to_pylist(), batch["usable"].to_pylist(), strict=True):
                if not usable or not tools:
                    pred.append(UNKNOWN), score.append(0.0), margin.append(0.0)
                    continue
                ranked = _ranked(text, tools, model.block_bytes)
                gap = (ranked[1][0] - ranked[0][0]) / ranked[1][0] if len(ranked) > 1 else 1.0
                pred.append(ranked[0][1]), margin.append(gap)
                score.append(1.0 - (1.0 - gap) ** 10)
            kept = [batch[i] for i, name in enumerate(batch.schema.names) if name not in ("text", "usable")]
            names = [name for name in batch.schema.names if name not in ("text", "usable")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(margin, pa.float64())],
                [*names, "lang_pred", "score", "margin"],
            )

    return classify


def predict_languages(
    docs: DataFrame,
    model: LanguageModel,
    min_margin: float = MIN_MARGIN,
    text_column: str = "text",
    keep: list[str] | None = None,
) -> DataFrame:
    """The ``keep`` columns of each row of ``docs``, with ``lang_pred``, ``score``, ``margin`` and ``rejected``.

    The letters of every whole text are compressed block by block with the dictionary of each language; the fewest bytes win, equal
    sizes go to the first language by name. ``margin`` is the share of bytes by which the second best is larger,
    ``score`` grows with it from 0 to 1. A margin below ``min_margin`` is rejected, as are texts that are
    null or have no letter (``und``, score 0). Rows are independent; nothing is shuffled. Only ``text_column`` is
    read for a prediction.
    """
    text = column(text_column)
    inner = docs.select(
        *[column(c).alias(f"k{i}") for i, c in enumerate(keep or [])],
        letters(text).alias("text"),
        F.coalesce(_has_letter(text), F.lit(False)).alias("usable"),
    )
    kept = [f for f in inner.schema.fields if f.name not in ("text", "usable")]
    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in kept), "lang_pred string", "score double", "margin double"])
    out = inner.mapInArrow(_classifier(model), schema)
    return out.select(
        *[F.col(f"k{i}").alias(c) for i, c in enumerate(keep or [])],
        "lang_pred",
        "score",
        "margin",
        ((F.col("lang_pred") == UNKNOWN) | (F.col("margin") < min_margin)).alias("rejected"),
    )


def held_out(id_column: Column) -> Column:
    """One document in four, by its id; never learned from."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit(""))) % 4 == 2
