"""Periodic runs: stretches of words that repeat with one period, found by uniting suffixes in order of falling LCP.

Suffixes of a text that share their first words form a class. Taken by decreasing length l of what they share, two
classes become one at a time, as in Kruskal's algorithm. Each keeps its positions in order. Where positions i < j of the
two become neighbours and j - i <= l, the words from i to j + l repeat with period j - i. A run of period q that starts
at s unites s and s + q exactly when l is its length less q, and no position can lie between them then: it would give the
run a smaller period. So every run shows up once at its own start, with its smallest period.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from viewmill.llm.common import with_key
from viewmill.llm.words import covered, repeated, slice_hashes

LEAST = 24
TIMES = 3
#: Positions of a class are kept in pieces of at most this many, so that adding one moves few others.
PIECE = 2048
_FACTOR = np.uint64(0x9E3779B97F4A7C15)

Run = tuple[int, int, int]


class Positions:
    """An ordered set of positions."""

    __slots__ = ("lows", "pieces", "size")

    def __init__(self, first: int):
        self.pieces, self.lows, self.size = [[first]], [first], 1

    def __iter__(self) -> Iterator[int]:
        return chain.from_iterable(self.pieces)

    def add(self, x: int) -> None:
        at = max(bisect_right(self.lows, x) - 1, 0)
        piece = self.pieces[at]
        insort(piece, x)
        self.lows[at] = piece[0]
        self.size += 1
        if len(piece) > PIECE:
            half = len(piece) // 2
            self.pieces[at : at + 1] = [piece[:half], piece[half:]]
            self.lows[at : at + 1] = [piece[0], piece[half]]

    def around(self, x: int) -> tuple[int | None, int | None]:
        """The neighbours of a member."""
        at = bisect_right(self.lows, x) - 1
        piece = self.pieces[at]
        i = bisect_left(piece, x)
        before = piece[i - 1] if i else self.pieces[at - 1][-1] if at else None
        if i + 1 < len(piece):
            return before, piece[i + 1]
        return before, self.pieces[at + 1][0] if at + 1 < len(self.pieces) else None


def suffixes(items: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The positions of a sequence in the order of what follows them, and how many items each shares with the one before.

    Ranks by the next 1, 2, 4, … items, each from two of the ranks before it, until all differ; what neighbours share is
    put together from the same ranks.
    """
    n = len(items)
    rank = np.unique(items, return_inverse=True)[1].astype(np.int64) + 1
    levels: list[tuple[int, np.ndarray]] = []
    step = 1
    while True:
        levels.append((step, np.append(rank, 0).astype(np.int32)))
        if rank.max(initial=0) == n:
            break
        pairs = rank * (n + 1)
        pairs[:-step] += rank[step:]
        rank = np.unique(pairs, return_inverse=True)[1].astype(np.int64) + 1
        step *= 2
    order = np.argsort(rank)
    shared = np.zeros(max(n, 1), dtype=np.int64)
    for step, ranks in reversed(levels):
        same = ranks[order[:-1] + shared[1:]] == ranks[order[1:] + shared[1:]]
        shared[1:] += step * same
    return order, shared[:n]


def united_neighbours(order: np.ndarray, shared: np.ndarray, depth: int) -> Iterator[tuple[int, int, int]]:
    """(i, j, l) for positions i < j that become neighbours when their classes unite at ``l`` >= ``depth`` shared items."""
    edges = np.flatnonzero(shared >= depth)
    edges = edges[np.argsort(-shared[edges], kind="stable")]
    above: dict[int, int] = {}
    members: dict[int, Positions] = {}

    def top(x: int) -> int:
        while x in above:
            if above[x] in above:
                above[x] = above[above[x]]
            x = above[x]
        return x

    for a, b, length in zip(order[edges - 1].tolist(), order[edges].tolist(), shared[edges].tolist(), strict=True):
        a, b = top(a), top(b)
        large, small = members.pop(a, None) or Positions(a), members.pop(b, None) or Positions(b)
        if large.size < small.size:
            a, b, large, small = b, a, small, large
        above[b] = a
        members[a] = large
        added = set(small)
        for x in added:
            large.add(x)
        for x in added:
            before, after = large.around(x)
            if before is not None and before not in added:
                yield before, x, length
            if after is not None and after not in added:
                yield x, after, length


def periodic_runs(items: np.ndarray, least: int = LEAST, times: int = TIMES) -> list[Run]:
    """(start, length, period) of every run of a sequence of numbers, by start, then period.

    A run is a stretch with smallest period q, of at least ``least`` items and ``times`` (2 or more) periods, that no
    neighbour extends keeping period q.
    """
    if least < 1 or times < 2:
        raise ValueError("a run has at least one item and two periods")
    # What the first two periods of a run share at least.
    depth = max(-(-least * (times - 1) // times), 1)
    n = len(items)
    if n < least:
        return []
    starts = np.arange(n - depth + 1)
    if not repeated(slice_hashes(items, starts, starts + depth, _FACTOR)).any():
        return []
    found = []
    for i, j, length in united_neighbours(*suffixes(items), depth):
        period = j - i
        if period * (times - 1) <= length and period + length >= least and (i == 0 or items[i - 1] != items[j - 1]):
            found.append((i, period + length, period))
    return sorted(found)


def numbered(words: list[bytes]) -> np.ndarray:
    """Words as numbers, the same number for the same word only."""
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    return np.fromiter(map(number.__getitem__, words), dtype=np.int64, count=len(words))


def collapsed(words: list[bytes], runs: Iterable[Run]) -> list[bytes]:
    """Words without those that a run holds after its first period."""
    low, length, period = np.array(list(runs)).T
    gone = covered(low + period, length - period, len(words)).tolist()
    return [w for w, g in zip(words, gone, strict=True) if not g]


def best_run(runs: list[Run]) -> Run | None:
    """The run with the greatest exact length / period; of equals the first, then the one of smallest period."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _as_struct(run: Run | None) -> dict | None:
    return None if run is None else dict(zip(("start", "length", "period"), run, strict=True))


def _search(least: int, times: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, found, best, kept = [], [], [], []
            for text in batch["text"]:
                # bytes.split cuts at space and \t \n \v \f \r only.
                words = text.as_py().encode().split()
                runs = periodic_runs(numbered(words), least, times) if len(words) >= least else []
                n_words.append(len(words))
                found.append([_as_struct(r) for r in runs])
                best.append(_as_struct(best_run(runs)))
                kept.append(b" ".join(collapsed(words, runs) if runs else words).decode())
            yield pa.RecordBatch.from_arrays(
                [
                    batch["id"],
                    batch["mark"],
                    pa.array(n_words, pa.int64()),
                    pa.array(found, pa.list_(_RUN)),
                    pa.array(best, _RUN),
                    pa.array(kept, pa.string()),
                ],
                ["id", "mark", "n_words", "runs", "best", "kept_text"],
            )

    return run


def collapse_periodic_runs(
    docs: DataFrame, least: int = LEAST, times: int = TIMES, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: ``id``, ``mark``, ``n_words``, ``runs``, ``best``, ``kept_text``.

    Words are what lies between space, \\t, \\n, \\v, \\f and \\r, numbered from 0. ``runs`` are all runs of at least
    ``least`` words and ``times`` periods (see :func:`periodic_runs`) as (start, length, period), by start, then period;
    ``best`` is the one with the greatest length / period, null without runs. ``kept_text`` joins by one space the words
    that no run holds after its first period.

    Every text is a task's own matter: no shuffle, and nothing that is lost with an executor. A text without a repeated
    sequence of 16 words (2/3 of ``least``) is done after one sort; others take n log n steps times the logarithm of
    what they repeat, so very long texts are searched whole.

    Null and empty texts have no words, no run and an empty text. Ties of length / period go to the smallest start,
    then period. Repeated rows each get the same result; ids may be null; other columns of ``docs`` are not read and may
    have any name. An empty table gives an empty table.
    """
    keyed = with_key(docs, id_column, text_column).select("id", "mark", "text")
    kind = keyed.schema["id"].dataType.simpleString()
    run = "struct<start: long, length: long, period: long>"
    return keyed.mapInArrow(
        _search(least, times),
        f"id {kind}, mark long, n_words long, runs array<{run}>, best {run}, kept_text string",
    )
