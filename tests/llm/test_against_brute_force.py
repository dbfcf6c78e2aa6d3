"""Every query against its plain version, on the test table and on the awkward cases."""

from __future__ import annotations

import pytest

from tests.llm import brute

ITEMS = [
    (1, " ".join(f"word{i}" for i in range(5, 25))),
    (2, "two words"),
    (3, None),
    (4, ""),
    (None, "Another TEXT"),
    (5, " ".join(f"WORD{i}" for i in range(5, 25))),
    (6, "with"),
]


@pytest.fixture(scope="session")
def items(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


@pytest.fixture(params=["documents", "awkward", "empty"])
def table(request):
    return request.getfixturevalue(request.param)


def pairs(table):
    return [(r["doc_id"], r["text"]) for r in table.select("doc_id", "text").collect()]


def test_contamination(as_query, table, items):
    got = as_query("op3", documents=table, benchmark=items).collect()
    assert brute.ordered(got) == brute.ordered(brute.contamination(pairs(table), ITEMS))


def test_contamination_by_real_benchmark_and_shuffled_join(spark, sf_dir, documents):
    from viewmill.llm.decontaminate import find_contamination

    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = find_contamination(documents, benchmark, broadcast_shingles=0).select("id", "n_words", "n_hit", "contaminated")
    wanted = brute.contamination(pairs(documents), [tuple(r) for r in benchmark.select("item_id", "text").collect()])
    assert brute.ordered(found.collect()) == brute.ordered((a, b, c, f) for a, b, c, _, _, f in wanted)
    assert any(w[-1] for w in wanted)


def test_near_duplicates(as_query, table):
    got = as_query("op4", documents=table).collect()
    assert brute.ordered(got) == brute.ordered(brute.near_duplicates(pairs(table)))


def test_line_dedup(as_query, table):
    got = as_query("op5", documents=table).collect()
    assert brute.ordered(got) == brute.ordered(brute.line_dedup(pairs(table)))


def test_substring_dedup(as_query, table):
    got = as_query("op9", documents=table).collect()
    assert brute.ordered(got) == brute.ordered(brute.substring_dedup(pairs(table)))


def test_personal_data(as_query, table):
    wanted = []
    for doc_id, text in pairs(table):
        spans = brute.personal_data(text)
        base = ",".join(f"{k}:{s}:{e}" for k, found in spans.items() for s, e in found)
        wanted.append((doc_id, *map(len, spans.values()), brute.sha(base), base))
    got = as_query("op2", documents=table).collect()
    assert brute.ordered(tuple(r)[:6] for r in got) == brute.ordered(w[:6] for w in wanted)
    # What the method adds comes after the base spans.
    for r in got:
        spans = [s for s in r["spans"].split(",") if s]
        base = [s for s in spans if not s.startswith("found:")]
        assert brute.sha(",".join(base)) == r["base_sha256"] and spans[: len(base)] == base


def test_secrets(as_query, table):
    wanted = []
    for doc_id, text in pairs(table):
        spans = brute.secrets(text)
        order = list(spans)
        base = sorted((s, order.index(k), e) for k, found in spans.items() for s, e in found)
        written = ",".join(f"{order[k]}:{s}:{e}" for s, k, e in base)
        wanted.append((doc_id, *map(len, spans.values()), brute.sha(written)))
    got = as_query("op7", documents=table).collect()
    assert brute.ordered(tuple(r)[:5] for r in got) == brute.ordered(wanted)


def test_statistics(spark, as_query, table):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = as_query("op8", documents=table, labels=labels).collect()
    wanted = [(doc_id, *brute.statistics(text)) for doc_id, text in pairs(table)]
    assert brute.ordered(tuple(r)[:7] for r in got) == brute.ordered(wanted)
    assert all(r["kept"] == (not r["base_failed"]) for r in got)


def test_mixing(as_query, table):
    got = as_query("op6", documents=table)
    rows, again = got.collect(), as_query("op6", documents=table.repartition(5)).collect()
    assert brute.ordered(rows) == brute.ordered(again)
    sizes: dict = {}
    for r in table.select("text", "source").collect():
        sizes[r["source"]] = sizes.get(r["source"], 0) + len(brute.words(r["text"]))
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    target, full = {}, set()
    while True:
        left = 1.5 * sum(sizes.values()) - sum(2 * sizes[s] for s in full)
        level = left / max(sum(weight[s] for s in names if s not in full), 1)
        target = {s: 2.0 * sizes[s] if s in full else weight[s] * level for s in names}
        above = {s for s in names if s not in full and target[s] > 2 * sizes[s]}
        if not above:
            break
        full |= above
    assert len(rows) == table.count()
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in rows)
    taken: dict = {}
    for r in rows:
        key = (r["source_size"], round(r["target"], 3))
        taken[key] = taken.get(key, 0) + r["taken"]
    wanted: dict = {}
    for s in names:
        key = (sizes[s], round(target[s], 3))
        wanted[key] = wanted.get(key, 0) + target[s]
    assert taken.keys() == wanted.keys()
    assert all(abs(taken[k] - wanted[k]) <= 3 for k in taken)


def test_language(as_query, table):
    import zlib

    got = as_query("op10", documents=table).collect()
    wanted = [(doc_id, zlib.crc32(str("" if doc_id is None else doc_id).encode()) % 4 == 2) for doc_id, _ in pairs(table)]
    assert brute.ordered((r["doc_id"], r["held_out"]) for r in got) == brute.ordered(wanted)
    assert all(0 <= r["score"] <= 1 for r in got)
    unknown = sum(not any(c.isalpha() for c in text or "") for _, text in pairs(table))
    assert sum(r["lang_pred"] == "und" for r in got) == unknown


def test_language_of_held_out_documents(as_query, documents):
    got = {r["doc_id"]: r for r in as_query("op10", documents=documents).collect()}
    rows = [r for r in documents.collect() if got[r["doc_id"]]["held_out"] and r["lang"]]
    right = sum(got[r["doc_id"]]["lang_pred"] == r["lang"] for r in rows)
    assert right >= 0.9 * len(rows)
    assert sum(got[r["doc_id"]]["rejected"] for r in rows) <= 0.03 * len(rows)
