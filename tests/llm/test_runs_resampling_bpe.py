"""Periodic runs, importance resampling and BPE, each against a plain version and by what its method promises."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import brute

TARGET = ["word1 word2 word3 short text", None, "", "two words é and WORDS again"]


@pytest.fixture(params=["documents", "awkward", "empty"])
def table(request):
    return request.getfixturevalue(request.param)


@pytest.fixture(scope="session")
def target(spark):
    return spark.createDataFrame([(t, "x", 1) for t in TARGET], "text string, id string, mark int")


def vocabulary():
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def pairs(table):
    return [(r["doc_id"], r["text"]) for r in table.select("doc_id", "text").collect()]


def docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


# --- periodic runs ----------------------------------------------------------------------------


def test_runs_as_a_query(as_query, table):
    got = as_query("op11", documents=table).collect()
    assert brute.ordered(got) == brute.ordered(brute.periodic_runs(pairs(table)))


def test_runs_in_small_alphabets():
    from viewmill.llm.periodic_runs import periodic_runs

    rng, some = random.Random(5), 0
    for _ in range(600):
        least, times = rng.choice([(24, 3), (6, 3), (4, 2), (9, 4), (1, 2)])
        w = [rng.randrange(rng.choice([1, 2, 3])) for _ in range(rng.randint(0, 60))]
        if len(w) > 3:
            a = rng.randrange(len(w))
            p = rng.randint(1, max(1, (len(w) - a) // 3))
            w = w[:a] + [w[a + (i - a) % p] for i in range(a, len(w))]
        want = brute.runs_of(w, least, times)
        assert periodic_runs(np.array(w, dtype=np.int64), least, times) == want
        some += bool(want)
    assert some > 300


def test_runs_of_very_long_texts():
    from viewmill.llm.periodic_runs import Positions, periodic_runs

    assert periodic_runs(np.zeros(200_000, dtype=np.int64)) == [(0, 200_000, 1)]
    assert periodic_runs(np.arange(200_000) % 1000) == [(0, 200_000, 1000)]
    assert periodic_runs(np.arange(200_000)) == []
    with pytest.raises(ValueError, match="two periods"):
        periodic_runs(np.zeros(9, dtype=np.int64), 4, 1)
    rng = random.Random(1)
    members = rng.sample(range(100_000), 9000)
    held = Positions(members[0])
    for x in members[1:]:
        held.add(x)
    ordered = sorted(members)
    assert list(held) == ordered and held.size == 9000 and len(held.pieces) > 3
    for i in range(0, 9000, 7):
        want = (ordered[i - 1] if i else None, ordered[i + 1] if i + 1 < 9000 else None)
        assert held.around(ordered[i]) == want


def test_best_run_and_what_is_left(spark):
    from viewmill.llm.periodic_runs import collapse_periodic_runs

    many, few = "a b " * 20, "x y z " * 20
    rows = collapse_periodic_runs(docs(spark, [f"{few}and {many}", "a " * 23, "a " * 24, f"{many}- {many}"])).collect()
    got = {r["id"]: r for r in rows}
    assert got[0]["kept_text"] == "x y z and a b" and tuple(got[0]["best"]) == (0, 60, 3)
    assert got[1]["best"] is None and got[1]["n_words"] == 23 and got[1]["kept_text"].count("a") == 23
    assert [tuple(r) for r in got[2]["runs"]] == [(0, 24, 1)] and got[2]["kept_text"] == "a"
    assert [tuple(r) for r in got[3]["runs"]] == [(0, 40, 2), (41, 40, 2)] and tuple(got[3]["best"])[0] == 0


def test_words_are_compared_and_not_their_hashes():
    from viewmill.llm.periodic_runs import numbered

    # Two words that polynomial hashes modulo 2^64 take for one.
    a = "a"
    for _ in range(11):
        a += a.translate(str.maketrans("ab", "ba"))
    b = a.translate(str.maketrans("ab", "ba"))
    assert numbered([a.encode(), b.encode(), a.encode()]).tolist() == [0, 1, 0]


# --- importance resampling --------------------------------------------------------------------


def test_resampling_as_a_query(as_query, table, target):
    got = as_query("op12", documents=table, benchmark=target).collect()
    assert brute.ordered(got) == brute.ordered(brute.resampled(pairs(table), TARGET))


@pytest.mark.parametrize("percent", [0, 30, 63, 100])
def test_resampling_with_ties_and_repeated_rows(spark, target, percent):
    from viewmill.llm.resampling import resample_documents

    rows = [(i % 40, "one two three") for i in range(200)] + [(None, "w " * 30)] * 7 + [(5, None)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = resample_documents(table, target, percent=percent, least_words=3, sketch=10).collect()
    wanted = 207 * percent // 100
    assert len(got) == 208 and sorted(r["rank"] for r in got if r["rank"]) == list(range(1, wanted + 1))
    ranked = sorted((r for r in got if r["n_words"] >= 3), key=lambda r: (-r["score"], r["id"] is None, r["id"] or 0))
    keys = [(r["score"], r["id"]) for r in ranked]
    drawn = sorted((r for r in got if r["rank"]), key=lambda r: r["rank"])
    assert [(r["score"], r["id"]) for r in drawn] == keys[:wanted]


def test_bracket_is_widened_until_it_holds_the_cutoff(spark):
    from viewmill.llm.resampling import score_bracket

    scores = spark.range(5000).select((F.col("id") % 977 * F.col("id")).alias("score"))
    ordered = sorted((r[0] for r in scores.collect()), reverse=True)
    for wanted in (1, 2, 250, 2500, 4999, 5000):
        for sketch in (2, 20, 10_000):
            low, high, above = score_bracket(scores, wanted, sketch)
            assert low <= ordered[wanted - 1] <= high and above == sum(s > high for s in ordered) < wanted
    same = spark.range(100).select(F.lit(7).alias("score"))
    assert score_bracket(same, 50) == (7, 7, 0)


def test_features_are_runs_of_words():
    import zlib

    from viewmill.llm.resampling import hashed_features

    n, found = hashed_features("Ab-c\x7fÉ 9")
    want = ["ab", "c", "É", "9", "ab c", "c É", "É 9", "ab c É", "c É 9"]
    assert n == 4 and found.tolist() == [zlib.crc32(w.encode()) % 10000 for w in want]
    assert hashed_features("-- ")[1].tolist() == []


# --- BPE --------------------------------------------------------------------------------------


def test_bpe_as_a_query(as_query, table):
    got = as_query("op13", documents=table).collect()
    assert brute.ordered(got) == brute.ordered(brute.coded(pairs(table), vocabulary()))


def test_bpe_of_odd_texts_in_small_blocks(spark):
    from viewmill.llm.word_bpe import encode_and_decode

    rng = random.Random(7)
    pool = [*"abXYZ'sdt0 \t\n\r\x0b\x0c.,-<|>_ßÀςΣİ", "e\u0301", "\u00a0", "\u3000", "\u200b", "각", "日本", "🙂", "\x1c"]
    pool += ["<|endoftext|>", "<|startoftext|>", "'ll", "\u0327\u0301", "\x00"]
    texts = ["".join(rng.choices(pool, k=rng.randrange(60))) for _ in range(400)] + ["word " * 3000]
    table = docs(spark, texts).repartition(3)
    got = encode_and_decode(table, vocabulary(), block_bytes=500).collect()
    want = {i: (n, ids, text) for i, n, ids, text in brute.coded(enumerate(texts), vocabulary())}
    import hashlib

    assert len(got) == len(texts)
    for r in got:
        assert (r["n_tokens"], hashlib.sha256(r["ids"]).hexdigest(), brute.sha(r["decoded"])) == want[r["id"]]


def test_each_distinct_word_is_encoded_once(spark, monkeypatch):
    from viewmill.llm import word_bpe

    seen = []

    class Encoding:
        ids = [1]

    class Counting:
        def encode_batch_fast(self, words, add_special_tokens):
            seen.extend(words)
            return [Encoding() for _ in words]

    import pyarrow as pa

    monkeypatch.setattr(word_bpe, "tokenizer_of", lambda definition: Counting())
    lists = [word_bpe._listed(w) for w in ([b"a", b"b"], [b"b", b"c", b"a"], [b"a"])]
    rows = {"block": [0, 1, 2], "range": [0, 0, 4], "words": lists}
    batch = pa.record_batch(rows)
    (out,) = word_bpe._encode("")(iter([batch]))
    assert seen == ["a", "b", "c", "a"] and out.num_rows == 3
    assert [word_bpe._grown(c).tolist() for c in out["counts"].to_pylist()] == [[1, 1], [1, 1, 1], [1]]


def test_texts_are_shuffled_once(spark, sf_dir):
    from viewmill.llm.queries import QUERIES

    df = QUERIES["op13_word_bpe"](spark, sf_dir)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan.split("Initial Plan")[0] and plan.split("Initial Plan")[0].count("FileScan") == 1


def test_tokenizers_that_look_across_blanks_are_refused():
    import public_tokenizers

    from viewmill.llm.word_bpe import read_definition

    with pytest.raises(ValueError, match="decoder|white space"):
        read_definition(public_tokenizers.path("byte_bpe_50k.json"))
