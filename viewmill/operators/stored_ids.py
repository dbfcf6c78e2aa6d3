"""Which ids of a batch are stored already, without reading all that is stored.

Strings compare by code point, which is their order in Spark and in the statistics of files.

Ids that grow with time, such as sequence numbers or ids that begin with a time stamp, lie close together in a batch,
apart from a few that come late. What lies between such clusters is left out when stored ids are read: first whole
loads by their smallest and greatest id, then row groups by their statistics, as the ids of a load are written in
order. Ids without order prune nothing that way; of a small batch they are compared with the Bloom filters of row
groups. Either way the answer is exact.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_
from os.path import commonprefix

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A batch is cut into this many stretches of equal width; the widest empty ones between them are left out.
CELLS = 4096
GAPS = 63
# Up to this many ids are compared with row groups one by one. At most as many as ``session.SETTINGS`` pushes down.
FEW_IDS = 200
_BYTES = 6

# How ids are written: row groups of some 100,000 ids in order, each with a Bloom filter.
ID_LAYOUT = {
    "parquet.block.size": str(4 * 1024 * 1024),
    "parquet.bloom.filter.enabled#view_id": "true",
    "parquet.bloom.filter.expected.ndv#view_id": "100000",
    "parquet.bloom.filter.fpp#view_id": "0.0001",
}


@dataclass(frozen=True)
class IdSpan:
    """Where the ids of a batch can lie: from ``low`` to ``high``, but not inside a gap (last before, first after), and
    if there are few of them nowhere but at ``ids``."""

    low: str
    high: str
    gaps: Sequence[tuple[str, str]] = ()
    ids: Sequence[str] = ()

    def may_hold(self, column: str) -> Column:
        """Whether an id can be in the batch."""
        if self.ids:
            return F.col(column).isin(list(self.ids))
        value = F.col(column)
        inside = [(value <= before) | (value >= after) for before, after in self.gaps]
        return reduce(and_, inside, (value >= self.low) & (value <= self.high))

    def may_overlap(self, low: str, high: str) -> bool:
        """Whether stored ids from ``low`` to ``high`` can hold one of the batch."""
        if self.ids:
            return any(low <= i <= high for i in self.ids)
        if high < self.low or low > self.high:
            return False
        return not any(before < low and high < after for before, after in self.gaps)


def _number(value: bytes) -> int:
    return int.from_bytes(value[:_BYTES].ljust(_BYTES, b"\0"), "big")


def id_span(ids: DataFrame, column: str, count: int, low: str, high: str) -> IdSpan:
    """The span of ``count`` non-null ids between ``low`` and ``high``, from one aggregate of at most ``CELLS`` rows."""
    if count <= FEW_IDS:
        return IdSpan(low, high, ids=sorted({r[0] for r in ids.select(column).distinct().collect()}))
    shared = len(commonprefix([low.encode(), high.encode()]))
    first, last = _number(low.encode()[shared:]), _number(high.encode()[shared:])
    if first == last:
        return IdSpan(low, high)
    digits = F.rpad(F.hex(F.substring(F.encode(F.col(column), "UTF-8"), shared + 1, _BYTES)), 2 * _BYTES, "0")
    cell = F.expr("(at - {}L) * {}L div {}L".format(first, CELLS, last - first + 1))
    cells = (
        ids.select(F.col(column).alias("id"), F.conv(digits, 16, 10).cast("bigint").alias("at"))
        .groupBy(cell.alias("cell"))
        .agg(F.min("id").alias("low"), F.max("id").alias("high"))
        .collect()
    )
    cells.sort(key=lambda c: c["cell"])
    between = [(a["high"], b["low"]) for a, b in zip(cells, cells[1:], strict=False)]
    between.sort(key=lambda g: _number(g[0].encode()[shared:]) - _number(g[1].encode()[shared:]))
    return IdSpan(low, high, gaps=sorted(between[:GAPS]))


def in_order(ids: DataFrame, column: str) -> DataFrame:
    """Ids by ranges, sorted within each, which makes their row groups narrow; to be written with ``ID_LAYOUT``."""
    return ids.select(column).repartitionByRange(column).sortWithinPartitions(column)
