"""Quality rules: text statistics, and decision lists learned from labels by sequential covering."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewmill.llm.common import column
from viewmill.llm.words import covered, repeated, word_groups

STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_chars", "n_lines", "n_digits", "n_upper")
WINDOW = 5
_SYMBOLS = np.zeros(256, dtype=bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
#: Labelled rows that a list is learned from, at most: those whose hashed ids are below the share that this is of all.
SAMPLE_ROWS = 20_000


def _dup_lines(text: str) -> tuple[int, int]:
    lines = text.split("\n")
    if len(lines) == 1:
        return 1, 0
    seen: set[str] = set()
    n = 0
    for line in lines:
        if line.strip(" \t\x0b\f\r"):
            n += line in seen
            seen.add(line)
    return len(lines), n


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch["text"]
        out = {name: np.zeros(len(texts), dtype=np.int64) for name in STATISTICS}
        for group in word_groups(texts):
            data, bounds = group.data, group.bounds
            many = slice(group.first, group.first + len(bounds) - 1)
            edges = group.offsets
            points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
            inside = np.concatenate([[0], np.cumsum(points[group.ends] - points[group.starts])])
            out["n_words"][many] = np.diff(bounds)
            out["word_chars"][many] = np.diff(inside[bounds])
            out["n_chars"][many] = np.diff(points[edges])
            for name, chosen in (
                ("n_symbols", _SYMBOLS[data]),
                ("n_digits", (data - np.uint8(48)) <= 9),
                ("n_upper", (data - np.uint8(65)) <= 25),
            ):
                out[name][many] = np.diff(np.concatenate([[0], np.cumsum(chosen)])[edges])
            values, among = group.windows(WINDOW)
            for i in range(len(bounds) - 1):
                if among[i + 1] - among[i] > 1:
                    again = np.flatnonzero(repeated(values[among[i] : among[i + 1]]))
                    if len(again):
                        out["n_repeat_words"][group.first + i] = covered(again, WINDOW, bounds[i + 1] - bounds[i]).sum()
        lines = [_dup_lines(t or "") for t in texts.to_pylist()]
        out["n_lines"][:] = [a for a, _ in lines]
        out["n_dup_lines"][:] = [b for _, b in lines]
        yield pa.RecordBatch.from_arrays([batch["id"], *map(pa.array, out.values())], ["id", *out])


def text_statistics(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id`` and :data:`STATISTICS` of every row's whole text.

    Words are runs without blanks. ``n_repeat_words`` counts words in windows of five words that the text has twice or
    more; ``n_dup_lines`` lines with a word that equal an earlier line. Null is an empty text: all 0, one line. Rows
    are independent and nothing is shuffled; memory follows the longest text of a batch.
    """
    inner = docs.select(column(id_column).alias("id"), column(text_column).cast("string").alias("text"))
    schema = f"id {inner.schema['id'].dataType.simpleString()}, " + ", ".join(f"{s} long" for s in STATISTICS)
    return inner.mapInArrow(_statistics, schema)


#: What rules may test, as numerator and denominator.
FEATURES = {
    "n_words": ("n_words", None),
    "n_chars": ("n_chars", None),
    "chars_per_word": ("word_chars", "n_words"),
    "symbols_per_word": ("n_symbols", "n_words"),
    "repeated_words": ("n_repeat_words", "n_words"),
    "repeated_lines": ("n_dup_lines", "n_lines"),
    "words_per_line": ("n_words", "n_lines"),
    "digits_per_char": ("n_digits", "n_chars"),
    "capitals_per_char": ("n_upper", "n_chars"),
}


def feature(name: str) -> Column:
    """A feature as a column; 0 where it would divide by 0."""
    top, bottom = FEATURES[name]
    if bottom is None:
        return F.col(top).cast("double")
    return F.when(F.col(bottom) > 0, F.col(top) / F.col(bottom)).otherwise(0.0)


@dataclass(frozen=True)
class Rule:
    """All (feature, ``<=`` or ``>``, threshold) hold: the document is of low quality."""

    tests: tuple[tuple[str, str, float], ...]
    precision: float
    support: int

    def condition(self) -> Column:
        out = F.lit(True)
        for name, sign, limit in self.tests:
            out = out & (feature(name) <= limit if sign == "<=" else feature(name) > limit)
        return out

    def __str__(self) -> str:
        return " and ".join(f"{n} {s} {x:.6g}" for n, s, x in self.tests) + f"  ({self.precision:.3f} of {self.support})"


def _held(x: np.ndarray, names: list[str], tests) -> np.ndarray:
    out = np.ones(len(x), dtype=bool)
    for name, sign, limit in tests:
        v = x[:, names.index(name)]
        out &= (v <= limit) if sign == "<=" else (v > limit)
    return out


def _gain(bad: np.ndarray, chosen: np.ndarray, before: float) -> float:
    """FOIL's: positives kept, times the bits by which precision rises."""
    n, p = chosen.sum(), (bad & chosen).sum()
    return p * (np.log2(p / n) - np.log2(before)) if p else -1.0


def learn_rules(
    rows: np.ndarray,
    bad: np.ndarray,
    names: list[str],
    max_rules: int = 12,
    max_tests: int = 3,
    candidates: int = 64,
    min_support: int = 8,
    min_precision: float = 0.9,
) -> list[Rule]:
    """An ordered list of rules for ``bad``, by sequential covering.

    Two thirds of the rows grow a rule: the test with the largest FOIL gain is added until no good row is left or
    none gains. The last third prunes it: tests are removed from the end while that does not lower its precision there.
    A rule stays if it holds for ``min_support`` rows at ``min_precision`` on each part; then what it covers is
    set aside, as is what a rule that does not stay covers, and the next is grown.
    """
    part = np.arange(len(rows)) % 3
    open_, rules = np.ones(len(rows), dtype=bool), []
    while len(rules) < max_rules:
        grow, prune = open_ & (part < 2), open_ & (part == 2)
        if not (bad & grow).any():
            break
        tests: list[tuple[str, str, float]] = []
        chosen = grow.copy()
        while len(tests) < max_tests and (chosen & ~bad).any():
            before = (bad & chosen).sum() / chosen.sum()
            best = (0.0, None)
            for j, name in enumerate(names):
                values = np.unique(rows[chosen, j])
                limits = (values[1:] + values[:-1]) / 2
                if len(limits) > candidates:
                    limits = limits[np.linspace(0, len(limits) - 1, candidates).astype(int)]
                for limit in limits:
                    low = rows[:, j] <= limit
                    for sign, side in (("<=", low), (">", ~low)):
                        gain = _gain(bad, chosen & side, before)
                        if gain > best[0]:
                            best = (gain, (name, sign, float(limit)))
            if best[1] is None:
                break
            tests.append(best[1])
            chosen &= _held(rows, names, tests[-1:])

        def precision(some, where):
            held = _held(rows, names, some) & where
            return (bad & held).sum() / held.sum() if held.any() else 0.0

        while len(tests) > 1 and precision(tests[:-1], prune) >= precision(tests, prune):
            tests.pop()
        if not tests:
            break
        held = _held(rows, names, tests) & open_
        if held.sum() >= min_support and min(precision(tests, grow), precision(tests, prune)) >= min_precision:
            rules.append(Rule(tuple(tests), float((bad & held).sum() / held.sum()), int(held.sum())))
        # Also where the rule is not good enough: else it would be grown again.
        open_ &= ~held
    return rules


def fit_rules(statistics: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, **options) -> list[Rule]:
    """Rules for ``quality = 0`` from ``statistics`` joined with ``labels`` (doc_id, quality).

    At most ``sample_rows`` labelled rows that pass the base rules are used: such rows are counted, and each is
    taken by a hash of its id at the rate that gives so many; a few beyond it are left out. Rows without a label,
    null labels and labels without a row are left out; without both kinds of label there are no rules.
    """
    marked = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    marked = marked.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    joined = statistics.where(~base_failed()).join(marked, F.col("id") == F.col("doc_id")).select(
        F.xxhash64("id").alias("order"), "quality", *[feature(f).alias(f) for f in FEATURES]
    )
    rate = min(1.0, sample_rows / max(joined.count(), 1))
    chance = F.pmod("order", F.lit(1 << 30)) / float(1 << 30)
    sample = sorted(joined.where(chance < rate).collect())[:sample_rows]
    rows = np.array([[r[f] for f in FEATURES] for r in sample]).reshape(len(sample), len(FEATURES))
    bad = np.array([r["quality"] == 0 for r in sample], dtype=bool)
    return learn_rules(rows, bad, list(FEATURES), **options) if bad.any() and not bad.all() else []


def verdict(rules: list[Rule]) -> Column:
    """The number, from 1, of the first rule that holds; null if none does."""
    out = F.lit(None).cast("int")
    for i, rule in reversed(list(enumerate(rules, 1))):
        out = F.when(rule.condition(), i).otherwise(out)
    return out


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
