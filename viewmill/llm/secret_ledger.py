"""Secret scans over a ledger of blobs: each distinct content is scanned once by each version of each rule."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewmill.llm.common import column, staged, with_key


@dataclass(frozen=True)
class Rule:
    """A pattern; a match counts if its ``group`` has ``least`` characters. A changed rule needs a new version."""

    name: str
    version: int
    pattern: str
    group: int = 0
    least: int = 1

    @property
    def key(self) -> str:
        return f"{self.name}@{self.version}"


#: The first three are what the result contract names.
RULES = (
    Rule(
        "assign",
        1,
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
    ),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 20),
    # Runs of 24 and more are the same as all runs of which the shorter ones are dropped.
    Rule("hex", 1, r"[0-9a-f]{24,}", 0, 24),
    Rule("pem", 1, r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----", 0, 1),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 1),
    Rule("forge", 1, r"(?:ghp|gho|ghu|ghs|ghr)_[A-Za-z0-9]{36,}", 0, 1),
)
BASE = ("assign", "access", "hex")
LEDGER = "blob string, scanned array<string>, findings array<struct<rule: string, start: int, end: int>>"


def blob_id(text: Column) -> Column:
    """Content address of a text."""
    return F.sha2(F.encode(text, "UTF-8"), 256)


def _scan(rules: tuple[Rule, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # ASCII: otherwise ignoring case would also take letters beyond A-Z for s and k.
        compiled = [(r, re.compile(r.pattern, re.ASCII)) for r in rules]
        kind = pa.list_(pa.struct([("rule", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            scanned, findings = [], []
            for text, done in zip(batch["text"], batch["done"], strict=True):
                text, done = text.as_py(), set(done.as_py() or ())
                todo = [(r, p) for r, p in compiled if r.key not in done]
                scanned.append([r.key for r, _ in todo])
                findings.append(
                    [
                        {"rule": r.key, "start": m.start(), "end": m.end()}
                        for r, p in todo
                        for m in p.finditer(text)
                        if m.end(r.group) - m.start(r.group) >= r.least
                    ]
                )
            yield pa.RecordBatch.from_arrays(
                [batch["blob"], pa.array(scanned, pa.list_(pa.string())), pa.array(findings, kind)],
                ["blob", "scanned", "findings"],
            )

    return run


def scan_new_blobs(
    versions: DataFrame,
    ledger: DataFrame | None = None,
    rules: tuple[Rule, ...] = RULES,
    text_column: str = "text",
) -> DataFrame:
    """Rows to append to the ledger (:data:`LEDGER`): for each distinct content what unseen rule versions find in it.

    ``versions`` has a row for every historical version of every path. Equal contents are folded in each task
    before the shuffle, so a content that a third of all rows has is a row per task there. A pair of blob and rule
    version that ``ledger`` has is not scanned again; blobs with no such pair left give no row. Nothing found is
    recorded as well. A null text is an empty one.
    """
    texts = versions.select(F.coalesce(column(text_column).cast("string"), F.lit("")).alias("text"))
    blobs = texts.groupBy(blob_id(F.col("text")).alias("blob")).agg(F.first("text").alias("text"))
    if ledger is None:
        blobs = blobs.withColumn("done", F.array().cast("array<string>"))
    else:
        # Grouped by blob on both sides: the second join reuses the partitioning of the first.
        done = ledger.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_set("scanned"))).alias("done"))
        wanted = F.array(*[F.lit(r.key) for r in rules])
        blobs = blobs.join(done, "blob", "left").select(
            "blob", "text", F.coalesce("done", F.array().cast("array<string>")).alias("done")
        )
        blobs = blobs.where(F.size(F.array_except(wanted, "done")) > 0)
    return blobs.mapInArrow(_scan(rules), LEDGER)


def findings_by_path(
    versions: DataFrame,
    ledger: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per row of ``versions``: ``id``, ``blob``, ``findings`` (rule name, start, end in code points).

    Findings are ordered by start, then by the order of ``rules``, then by end. Only findings of the given rule
    versions count. Contents with findings are written first: the join then is between two plain tables, so Spark can
    split a content with very many paths, or broadcast what it has measured to be small.
    Null ids are kept; a null text has the empty content; repeated rows get a row each; no rows, no rows.
    """
    place = F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (r.key, i)])
    names = F.array(*[F.lit(r.name) for r in rules])
    found = (
        ledger.select("blob", F.explode("findings").alias("f"))
        .where(F.col("f.rule").isin([r.key for r in rules]))
        .select("blob", F.struct(F.col("f.start"), place[F.col("f.rule")].alias("place"), F.col("f.end")).alias("f"))
        .groupBy("blob")
        .agg(F.sort_array(F.collect_set("f")).alias("f"))
    )
    found = staged(found, "findings")
    keyed = with_key(versions, id_column, text_column).select("id", blob_id(F.col("text")).alias("blob"))
    findings = F.transform(
        "f", lambda x: F.struct(F.get(names, x.place).alias("rule"), x.start.alias("start"), x.end.alias("end"))
    )
    return keyed.join(found, "blob", "left").select(
        "id", "blob", F.coalesce(findings, F.expr("cast(array() as array<struct<rule: string, start: int, end: int>>)")).alias("findings")
    )


def written(findings: Column) -> Column:
    """``kind:start:end`` of findings, joined by commas."""
    one = F.transform(findings, lambda f: F.concat_ws(":", f.rule, f.start.cast("string"), f.end.cast("string")))
    return F.array_join(one, ",")
