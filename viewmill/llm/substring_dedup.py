"""Words in passages that occur twice, found with super-k-mers: runs of windows that share a minimiser."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewmill.llm.common import join_documents, staged, with_key
from viewmill.llm.words import covered, slice_hashes, word_groups

WINDOW, MINIMISER = 35, 8
#: Windows of a minimiser with more positions than this travel alone, each to the bucket of its own hash.
HOT = 1000
#: Rows of whole buckets that are sorted at a time.
SORT_ROWS = 20_000
_FACTORS = np.uint64(0x8CB92BA72F3D8DD7), np.uint64(0xD6E8FEB86659FD93)


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _minima(values: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Smallest of each ``width`` neighbouring values, and where it is first."""
    low, at, span = values, np.arange(len(values)), 1

    def pairs(step: int):
        a, b = slice(0, len(low) - step), slice(step, len(low))
        right = low[b] < low[a]
        return np.where(right, low[b], low[a]), np.where(right, at[b], at[a])

    while span * 2 <= width:
        low, at = pairs(span)
        span *= 2
    return pairs(width - span) if width > span else (low, at)


def _runs(window: int, size: int):
    """Super-k-mers of each text: first window, number of windows, minimiser, its number of positions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group in word_groups(batch["text"]):
                values, among = group.windows(size)
                n_windows = np.maximum(np.diff(group.bounds) - window + 1, 0)
                total = int(n_windows.sum())
                if not total:
                    continue
                low, at = _minima(values, window - size + 1)
                text = np.repeat(np.arange(len(n_windows)), n_windows)
                within = np.arange(total) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows)
                first = within + among[:-1][text]
                low, at = low[first], at[first]
                new = np.ones(total, dtype=bool)
                new[1:] = (low[1:] != low[:-1]) | (text[1:] != text[:-1])
                moved = np.ones(total, dtype=np.int64)
                moved[1:] = new[1:] | (at[1:] != at[:-1])
                heads = np.flatnonzero(new)
                rows = pa.array(text[heads] + group.first)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["id"].take(rows),
                        batch["mark"].take(rows),
                        pa.array(within[heads].astype(np.int32)),
                        pa.array(np.diff(np.append(heads, total)).astype(np.int32)),
                        _signed(low[heads]),
                        pa.array(np.add.reduceat(moved, heads)),
                    ],
                    ["id", "mark", "start", "n", "minimiser", "positions"],
                )

    return run


def _strings(text: str | None, runs: list[dict], window: int) -> Iterator[tuple[int, bytes, int]]:
    """Bucket, packed string and first word of every run; runs of hot minimisers window by window."""
    words = (text or "").encode().split()
    packed = b" ".join(words)
    at = np.concatenate([[0], np.cumsum([len(w) + 1 for w in words])]).tolist()
    for run in runs:
        start, n = run["start"], run["n"]
        if run["hot"]:
            for i in range(start, start + n):
                one = packed[at[i] : at[i + window] - 1]
                yield xxhash.xxh3_64_intdigest(one, 1) - (1 << 63), one, i
        else:
            yield run["minimiser"], packed[at[start] : at[start + n + window - 1] - 1], start


def _pack(window: int):
    """Distinct packed strings of each batch, with how often they are there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[tuple[int, bytes], int] = {}
            for text, runs in zip(batch["text"], batch["runs"], strict=True):
                for bucket, packed, _ in _strings(text.as_py(), runs.as_py(), window):
                    seen[bucket, packed] = seen.get((bucket, packed), 0) + 1
                if len(seen) > 50_000:
                    yield _packed(seen)
                    seen = {}
            yield _packed(seen)

    return run


def _packed(seen: dict[tuple[int, bytes], int]) -> pa.RecordBatch:
    strings = pa.array([p for _, p in seen], pa.binary()).cast(pa.string())
    return pa.RecordBatch.from_arrays(
        [pa.array([b for b, _ in seen], pa.int64()), strings, pa.array(list(seen.values()), pa.int64())],
        ["bucket", "packed", "copies"],
    )


def _places(window: int):
    """Where each packed string is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, buckets, prints, starts = [], [], [], []
            for i, (text, runs) in enumerate(zip(batch["text"], batch["runs"], strict=True)):
                for bucket, packed, start in _strings(text.as_py(), runs.as_py(), window):
                    rows.append(i), buckets.append(bucket), starts.append(start)
                    prints.append(xxhash.xxh3_64_intdigest(packed) - (1 << 63))
            taken = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch["id"].take(taken),
                    batch["mark"].take(taken),
                    pa.array(buckets, pa.int64()),
                    pa.array(prints, pa.int64()),
                    pa.array(starts, pa.int32()),
                ],
                ["id", "mark", "bucket", "print", "start"],
            )

    return run


def _sorted_windows(rows: pa.Table, window: int) -> pa.RecordBatch:
    """Of whole buckets: the packed strings with windows that are there twice, and the words those cover."""
    merged: dict[tuple[int, str], int] = {}
    columns = (rows["bucket"].to_pylist(), rows["packed"].to_pylist(), rows["copies"].to_pylist())
    for bucket, packed, copies in zip(*columns, strict=True):
        merged[bucket, packed] = merged.get((bucket, packed), 0) + copies
    strings = [p for _, p in merged]
    copies = np.array(list(merged.values()), dtype=np.int64)
    first, second, owner, place = [], [], [], []
    for group in word_groups(pa.array(strings, pa.string())):
        counts = np.diff(group.bounds) - window + 1
        begin = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        start = begin + np.repeat(group.bounds[:-1], counts)
        first.append(slice_hashes(group.hashes, start, start + window, _FACTORS[0]))
        second.append(slice_hashes(group.hashes, start, start + window, _FACTORS[1]))
        owner.append(np.repeat(np.arange(len(counts)) + group.first, counts))
        place.append(begin)
    first, second, owner, place = (np.concatenate(x) for x in (first, second, owner, place))
    order = np.lexsort((second, first))
    a, b = first[order], second[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    times = np.add.reduceat(copies[owner[order]], np.flatnonzero(new))[np.cumsum(new) - 1]
    twice = np.zeros(len(order), dtype=bool)
    twice[order] = times > 1
    keys = list(merged)
    buckets, prints, spans = [], [], []
    bounds = np.searchsorted(owner, np.arange(len(keys) + 1))
    for i in np.unique(owner[twice]).tolist():
        mine = slice(bounds[i], bounds[i + 1])
        at = place[mine][twice[mine]]
        cut = np.flatnonzero(np.diff(at) > window) + 1
        heads, ends = at[np.append(0, cut)], at[np.append(cut - 1, len(at) - 1)] + window
        buckets.append(keys[i][0])
        prints.append(xxhash.xxh3_64_intdigest(strings[i].encode()) - (1 << 63))
        spans.append([{"low": int(s), "high": int(e)} for s, e in zip(heads, ends, strict=True)])
    kind = pa.list_(pa.struct([("low", pa.int32()), ("high", pa.int32())]))
    return pa.RecordBatch.from_arrays(
        [pa.array(buckets, pa.int64()), pa.array(prints, pa.int64()), pa.array(spans, kind)],
        ["bucket", "print", "spans"],
    )


def _count(window: int, sort_rows: int):
    """Counts windows in rows that come sorted by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        n = 0
        for batch in batches:
            for piece in (batch.slice(i, sort_rows) for i in range(0, batch.num_rows, sort_rows)):
                waiting.append(piece)
                n += piece.num_rows
                if n < sort_rows:
                    continue
                table = pa.Table.from_batches(waiting)
                last = table["bucket"][n - 1].as_py()
                whole = int(np.searchsorted(table["bucket"].to_numpy(), last))
                if whole:
                    yield _sorted_windows(table.slice(0, whole), window)
                waiting = table.slice(whole).to_batches()
                n -= whole
        if n:
            yield _sorted_windows(pa.Table.from_batches(waiting), window)

    return run


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["n_words", "n_removed", "kept_text"]
    for batch in batches:
        n_words, n_removed, kept = [], [], []
        for text, spans in zip(batch["text"], batch["spans"], strict=True):
            words = (text.as_py() or "").encode().split()
            found = spans.as_py()
            n_words.append(len(words))
            if found:
                low, high = np.array([(s["low"], s["high"]) for s in found]).T
                gone = covered(low, high - low, len(words)).tolist()
                words = [w for w, g in zip(words, gone, strict=True) if not g]
            n_removed.append(n_words[-1] - len(words))
            kept.append(b" ".join(words).decode())
        rest = [i for i, c in enumerate(batch.schema.names) if c not in ("text", "spans")]
        yield pa.RecordBatch.from_arrays(
            [
                *[batch[i] for i in rest],
                pa.array(n_words, pa.int64()),
                pa.array(n_removed, pa.int64()),
                pa.array(kept, pa.string()),
            ],
            [*[batch.schema.names[i] for i in rest], *names],
        )


def remove_repeated_passages(
    docs: DataFrame,
    window: int = WINDOW,
    minimiser: int = MINIMISER,
    hot: int = HOT,
    sort_rows: int = SORT_ROWS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: ``id``, ``mark``, ``n_words``, ``n_removed``, ``kept_text``.

    A word goes if it lies in a window of ``window`` words whose word sequence starts anywhere else as well, in the
    same or another document. All windows are judged on the input.

    A window's minimiser is the least hash among its runs of ``minimiser`` words; equal windows have equal
    minimisers. Consecutive windows with one minimiser are a super-k-mer. Minimisers are counted first, as numbers:
    one that has a single position in the whole input has no window that repeats. The others' super-k-mers travel as
    one packed string each to the bucket of their minimiser, combined in each task before the shuffle, so a passage
    of a third of all documents is a few rows. In the bucket all windows are sorted and counted. The spans that
    repeat go back to every place of their packed string, and from there to the documents.

    Minimisers of more than ``hot`` positions are split: their windows travel alone, by their own hash. Occurrences
    meet counts in joins that Spark can split; texts are shuffled once for all three uses.

    Null and empty texts have no words. Texts shorter than a window lose nothing. A repeated row repeats all its
    windows, so both lose them. Ids may be null. An empty table gives an empty table.
    """
    keyed = with_key(docs, id_column, text_column).select("id", "mark", "text")
    kind = keyed.schema["id"].dataType.simpleString()
    runs = keyed.mapInArrow(
        _runs(window, minimiser), f"id {kind}, mark long, start int, n int, minimiser long, positions long"
    )
    times = runs.groupBy("minimiser").agg(F.sum("positions").alias("times")).where("times > 1")
    # Written, so that the join is between two plain tables: Spark can split a minimiser with very many runs there.
    times = staged(times, "minimisers")
    wanted = (
        runs.join(times, "minimiser")
        .groupBy("id", "mark")
        .agg(F.collect_set(F.struct("start", "n", "minimiser", (F.col("times") > hot).alias("hot"))).alias("runs"))
    )
    chosen = join_documents(keyed, wanted).where(F.col("runs").isNotNull())
    chosen = chosen.select("id", "mark", "text", "runs")
    found = (
        chosen.mapInArrow(_pack(window), "bucket long, packed string, copies long")
        .repartition("bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(
            _count(window, sort_rows), "bucket long, print long, spans array<struct<low: int, high: int>>"
        )
    )
    places = chosen.mapInArrow(_places(window), f"id {kind}, mark long, bucket long, print long, start int")
    spans = (
        places.join(found, ["bucket", "print"])
        .select(
            "id",
            "mark",
            F.transform(
                "spans",
                lambda s: F.struct((s.low + F.col("start")).alias("low"), (s.high + F.col("start")).alias("high")),
            ).alias("spans"),
        )
        .groupBy("id", "mark")
        .agg(F.flatten(F.collect_set("spans")).alias("spans"))
    )
    joined = join_documents(keyed, spans).select("id", "mark", "text", "spans")
    return joined.mapInArrow(
        _removed, f"id {kind}, mark long, n_words long, n_removed long, kept_text string"
    )
