"""What each method does beyond the columns that its query returns."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import brute


def docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


# --- HTML -------------------------------------------------------------------------------------

PAGE = """<!doctype html><html><head><title>T</title><script>if (a < b) { x("</p>") }</script></head><body>
<header><a href="/">Site</a></header><nav><ul><li><a href=1>Home</a><li><a href=2>News</a></ul></nav>
<div class="cookie-notice">We use cookies. Please accept them all.</div>
<div id="content"><h1>A title</h1><p>First &amp; foremost,  a long enough paragraph of text, with <b>bold</b> words in it.
<p>Second paragraph&nbsp;that also runs on for a while &lt;here&gt; and ends.</p>
<div class="ad-box">Buy now! Great offers for you and everybody else today.</div>
<p>Third paragraph, which comes after the advert and still belongs to it.</p></div>
<aside>Related stories</aside><form><label>Your mail</label><input></form>
<section class="comments"><p>I think this is a very long reader comment that should not be here.</p></section>
<footer>&copy; Somebody. All rights reserved.</footer></body></html>"""


def test_page_without_article_element():
    from viewmill.llm.html_mincut import main_text

    assert main_text(PAGE) == (
        "A title First & foremost, a long enough paragraph of text, with bold words in it. "
        "Second paragraph that also runs on for a while <here> and ends. "
        "Third paragraph, which comes after the advert and still belongs to it."
    )


def test_article_header_is_content_and_broken_markup_is_survived():
    from viewmill.llm.html_mincut import main_text

    page = "<article><header><h1>Head</h1></header><p>Some words follow here, enough of them.<!-- open <p>gone"
    assert main_text(page) == "Head Some words follow here, enough of them."
    for broken in ("<", "<p", '<p class="x>text', "</p></div>", "&#xZZ; &#0;", "<script>never closed", "<!--"):
        main_text(broken)
    assert [main_text(x) for x in (None, "", " \n")] == ["", "", ""]


TEXT = "<h1>Of rivers</h1><p>The river rose for three days and took the old bridge with it.</p><p>Nobody was hurt, they say.</p>"
MAIN = "Of rivers The river rose for three days and took the old bridge with it. Nobody was hurt, they say."


@pytest.mark.parametrize("inner", [f"<article>{TEXT}</article>", f"<main>{TEXT}</main>"])
@pytest.mark.parametrize(
    "wrapper", ['div class="content-sidebar-wrap"', 'div class="layout has-sidebar"', 'div id="page" class="comments-open"',
                'div class="no-sidebar"', 'form id="aspnetForm"', 'div class="widget-area"']
)
def test_article_in_a_wrapper_named_after_something_else(wrapper, inner):
    from viewmill.llm.html_mincut import main_text

    page = (
        f"<body><nav><a href=/>Home</a><a href=/x>More of it</a></nav><{wrapper}>{inner}"
        '<div class="sidebar"><p>Read our other stories here.</p></div>'
        '<section class="comments"><article class="comment"><p>I was there and saw it, too.</p></article></section>'
        f"</{wrapper.split()[0]}><footer>All rights reserved.</footer></body>"
    )
    assert main_text(page) == MAIN


def test_comments_stay_out_however_long():
    from viewmill.llm.html_mincut import main_text

    comment = "<article><p>I have a great deal to say about this river, and here it all comes, at length.</p></article>"
    page = f'<body><article>{TEXT}</article><div id="comments">{comment * 30}</div></body>'
    assert main_text(page) == MAIN


def test_pages_as_a_query(spark, as_query, sf_dir):
    import html
    import re

    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    odd = spark.createDataFrame([(None, None, None), (-1, "u", ""), (-1, "u", "")], "page_id long, url string, html string")
    got = as_query("op1", pages=pages.unionByName(odd)).collect()
    want = []
    for p in pages.collect():
        inner = re.search("<article>(.*?)</article>", p["html"], re.S)[1]
        text = html.unescape(re.sub("<[^>]*>", "", re.sub("</?(?:p|h1|br)[^>]*>", " ", inner)))
        text = " ".join(text.split())
        want.append((p["page_id"], p["url"], text, len(text)))
    want += [(None, None, "", 0), (-1, "u", "", 0), (-1, "u", "", 0)]
    assert brute.ordered(got) == brute.ordered(want)


def test_minimum_cut_by_all_labellings():
    from viewmill.llm.html_mincut import minimum_cut

    rng = random.Random(3)
    for _ in range(60):
        n = rng.randint(1, 7)
        source, sink = ([rng.randrange(20) for _ in range(n)] for _ in range(2))
        edges = [(*rng.sample(range(n), 2), rng.randrange(15)) for _ in range(rng.randrange(9))] if n > 1 else []

        def cost(side, source=source, sink=sink, edges=edges):
            own = sum(t if content else s for s, t, content in zip(source, sink, side, strict=True))
            return own + sum(w for a, b, w in edges if side[a] != side[b])

        best = min(cost([bool(m >> i & 1) for i in range(n)]) for m in range(1 << n))
        assert cost(minimum_cut(source, sink, edges)) == best


# --- language -------------------------------------------------------------------------------


def test_language_made_of_copies_is_learned(spark):
    """Copies do not thin out the sample: few texts, each very often, are all in it."""
    from viewmill.llm.language_id import fit_languages, predict_languages

    rng = random.Random(8)
    words = {k: ["".join(rng.choices(a, k=7)) for _ in range(25)] for k, a in (("aa", "abcdefghi"), ("bb", "jklmnopqr"))}

    def text(lang):
        return " ".join(rng.choices(words[lang], k=30))

    rows = [("aa", text("aa")) for _ in range(300)] + [("bb", t) for t in [text("bb") for _ in range(3)] for _ in range(2000)]
    labelled = spark.createDataFrame(rows, "lang string, text string")
    model = fit_languages(labelled, sample_rows=40)
    assert sorted(model.dictionaries) == ["aa", "bb"]
    assert 15 <= model.dictionaries["aa"].count(b"\n") + 1 <= 80 and model.dictionaries["bb"].count(b"\n") == 2
    fresh = spark.createDataFrame([(lang, text(lang)) for lang in words for _ in range(20)], "lang string, text string")
    got = predict_languages(fresh, model, keep=["lang"])
    assert got.where("lang <> lang_pred").count() <= 2


# --- PII --------------------------------------------------------------------------------------


def test_contexts_of_known_identifiers_find_unknown_ones(spark):
    from viewmill.llm.pii_bootstrap import find_personal_data

    texts = [f"Please write to contact: person{i}@mail{i}.example.org about it" for i in range(12)]
    texts += ["Please write to contact: @handle77, thanks", "Room 101 is on floor 12345 today"]
    found = {r["id"]: r["found"] for r in find_personal_data(docs(spark, texts)).collect()}
    assert [(s["start"], s["end"], s["match"]) for s in found[12]] == [(25, 34, "@handle77")]
    assert found[13] == [] and all(found[i] == [] for i in range(12))


def test_found_identifiers_make_further_patterns_trusted(spark):
    """Seeds stand after one word, found tokens after that and another word, and what is found last after the other word only."""
    from viewmill.llm.pii_bootstrap import find_personal_data

    texts = [f"contact: person{i}@mail{i}.example.org" for i in range(400)]
    texts += [f"contact: U-{100 + i} and then badge: U-{100 + i} here" for i in range(30)]
    texts += ["their badge: ZZ-9000, of course", "room Q-7700 is empty"]
    found = {r["id"]: [s["match"] for s in r["found"]] for r in find_personal_data(docs(spark, texts)).collect()}
    assert all(found[400 + i] == [f"u-{100 + i}"] * 2 for i in range(30))
    assert found[430] == ["zz-9000"] and found[431] == []


def test_contexts_are_the_words_before_whatever_they_hold(spark):
    """Words with digits, long tokens, and an identifier straight after another one."""
    from viewmill.llm.pii_bootstrap import find_personal_data

    long = "ID" + "x7" * 400
    texts = [f"see ref2: person{i}@mail{i}.example.org" for i in range(12)]
    texts += ["see ref2: ID77-9", f"see ref2: ({long})", "see other ID77-8"]
    found = {r["id"]: [s["match"] for s in r["found"]] for r in find_personal_data(docs(spark, texts)).collect()}
    assert found[12] == ["id77-9"] and found[13] == [long.lower()] and found[14] == []


def test_very_many_identifiers_in_one_text(spark):
    """Time grows with the text, not with the square of its identifiers."""
    import time

    from viewmill.llm.pii_bootstrap import find_personal_data

    def seconds(n):
        texts = [" ".join(f"mail p{i}@q{i}.org," for i in range(n)), ",".join(f"p{i}@q{i}.org" for i in range(n)), "9." * n + "x" * n]
        start = time.time()
        sizes = {r["id"]: len(r["email"]) for r in find_personal_data(docs(spark, texts)).collect()}
        assert sizes == {0: n, 1: n, 2: 0}
        return time.time() - start

    seconds(100)
    assert seconds(40_000) < 40


def test_totals_of_long_arrays(spark):
    from viewmill.llm.common import running_totals

    for n in (0, 1, 255, 256, 257, 1000):
        got = spark.range(1).select(running_totals(F.lit(list(range(n))).cast("array<bigint>"), 256).alias("t")).first()["t"]
        assert got == [sum(range(i)) for i in range(n)]


# --- hashes of words -----------------------------------------------------------------------------


def test_long_words_of_two_letters_are_told_apart(as_query, spark):
    """Words whose sums of powers of any odd factor are equal: no passage repeats and no documents link."""
    word = "".join("ab"[i.bit_count() % 2] for i in range(1024))
    other = word.translate(str.maketrans("ab", "ba"))
    rest = [f"w{i}" for i in range(34)]
    texts = [" ".join([*rest[:17], w, *rest[17:]]) for w in (word, other)] + [" ".join([w] * 4) for w in (word, other)]
    table = spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string")
    assert {r["doc_id"]: r["n_removed"] for r in as_query("op9", documents=table).collect()} == dict.fromkeys(range(4), 0)
    assert all(r["component_id"] == r["doc_id"] for r in as_query("op4", documents=table).collect())


# --- near duplicates --------------------------------------------------------------------------


@pytest.mark.parametrize("sift", [4_000_000, 0])
def test_large_group_of_near_copies(spark, monkeypatch, sift):
    """A hot group, far beyond a region: the components are those of all pairs, whether wanted texts are sifted or shuffled."""
    from viewmill.llm import common
    from viewmill.llm.lsh_forest import near_duplicate_groups

    monkeypatch.setattr(common, "SIFT_ROWS", sift)

    rng = random.Random(1)
    base = [f"w{rng.randrange(500)}" for _ in range(160)]
    texts = [" ".join(base)] * 40
    for _ in range(260):
        copy = list(base)
        for _ in range(rng.randint(1, 5)):
            copy[rng.randrange(len(copy))] = f"x{rng.randrange(10**6)}"
        texts.append(" ".join(copy))
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    found = near_duplicate_groups(spark.createDataFrame(rows, "doc_id long, text string"), region=16, split=32)
    got = [(r["id"], r["n_shingles"], r["component_id"], r["kept"]) for r in found.collect()]
    assert brute.ordered(got) == brute.ordered(brute.near_duplicates(rows))


def test_crowded_regions_lose_no_link(spark):
    """One region without any link so far: comparing its blocks alone gives the components of all pairs."""
    from viewmill.llm.common import with_key
    from viewmill.llm.components import connected_components
    from viewmill.llm.crowded import completed_components

    rng = random.Random(5)
    texts = []
    for family in range(25):
        own = [f"w{i}" for i in range(rng.randint(60, 140))] + [f"f{family}-{i}" for i in range(40)]
        texts.append(" ".join(own))
        # A chain: each is one word from the one before, its ends may be too far apart to link.
        for step in range(rng.randint(0, 7)):
            own[rng.randrange(len(own))] = f"m{family}-{step}"
            texts.append(" ".join(own))
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    want = brute.near_duplicates(rows)
    members = [(0, i, 0, n, len(t)) for (i, t), (_, n, *_) in zip(rows, want, strict=True)]
    members = spark.createDataFrame(members, "region long, c1 long, c2 long, n_shingles long, chars long")
    keyed = with_key(spark.createDataFrame(rows, "doc_id long, text string"))
    members = members.join(keyed.select("id", "mark"), members.c1 == keyed.id)
    node = "struct<c1: bigint, c2: bigint>"
    none = connected_components(spark.createDataFrame([], f"a {node}, b {node}"))
    found = completed_components(members, none, keyed, percent=85, size=5, block=3, block_chars=2000, split=7)
    got = {r.node.c1: r.label.c1 for r in found.collect()}
    assert {i: got.get(i, i) for i, _ in rows} == {w[0]: w[2] for w in want}
    assert 20 <= sum(w[3] for w in want) < len(rows) - 20


def test_pairs_that_longer_prefixes_part(spark):
    """Templated texts in pairs: the prefixes of a crowded region grow, and a pair has no third text to join it."""
    from viewmill.llm.lsh_forest import near_duplicate_groups

    rng = random.Random(11)
    texts = []
    for family in range(24):
        own = [f"w{i}" for i in range(300)] + [f"f{family}-{i}" for i in range(60)]
        other = list(own)
        for step in range(4):
            other[20 + 70 * step] = f"m{family}-{step}"
        texts += [" ".join(own), " ".join(other)]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    found = near_duplicate_groups(spark.createDataFrame(rows, "doc_id long, text string"), trees=4, least=1, region=4, split=16)
    got = [(r["id"], r["n_shingles"], r["component_id"], r["kept"]) for r in found.collect()]
    want = brute.near_duplicates(rows)
    assert sum(w[3] for w in want) == 24 and brute.ordered(got) == brute.ordered(want)


def test_components_of_chains_and_stars(spark):
    from viewmill.llm.components import connected_components

    edges = [(i, i + 1) for i in range(50)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, 201), (201, 200), (None, 3)]
    found = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    want = {**{i: 0 for i in range(51)}, **{i: 100 for i in range(100, 160)}, 200: 200, 201: 200}
    assert {r["node"]: r["label"] for r in found} == want and len(found) == len(want)
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- passages ---------------------------------------------------------------------------------


def test_hot_minimisers_and_small_sorts(spark):
    """Minimisers split to single windows, and buckets that end within a batch: the result is the same."""
    from viewmill.llm.substring_dedup import remove_repeated_passages

    rng = random.Random(2)
    passage = " ".join(f"p{i}" for i in range(60))
    texts = [" ".join(f"w{rng.randrange(30)}" for _ in range(rng.randrange(80))) + " " + passage for _ in range(30)]
    texts += ["a b " * 200, "c " * 40, passage]
    found = remove_repeated_passages(docs(spark, texts), hot=3, sort_rows=4)
    got = [(r["id"], r["n_words"], r["n_removed"], brute.sha(r["kept_text"])) for r in found.collect()]
    assert brute.ordered(got) == brute.ordered(brute.substring_dedup(list(enumerate(texts))))


# --- secrets ----------------------------------------------------------------------------------


def test_only_unseen_blobs_and_rule_versions_are_scanned(spark):
    from dataclasses import replace

    from viewmill.llm.secret_ledger import RULES, findings_by_path, scan_new_blobs

    first = docs(spark, ["token = abcdef12", "nothing", "token = abcdef12"])
    ledger = scan_new_blobs(first)
    assert ledger.count() == 2
    later = docs(spark, ["token = abcdef12", "secret: 0123456789abcdef01234567"])
    new = scan_new_blobs(later, ledger)
    assert new.count() == 1
    assert scan_new_blobs(later, ledger.unionByName(new)).count() == 0
    changed = (replace(RULES[0], version=2), *RULES[1:])
    again = scan_new_blobs(first, ledger, changed).collect()
    assert sorted(r["scanned"] for r in again) == [["assign@2"], ["assign@2"]]
    paths = findings_by_path(first, ledger).collect()
    assert sorted((r["id"], [tuple(f) for f in r["findings"]]) for r in paths) == [
        (0, [("assign", 0, 16)]),
        (1, []),
        (2, [("assign", 0, 16)]),
    ]


# --- quality rules ----------------------------------------------------------------------------


def test_rules_cover_what_is_bad():
    from viewmill.llm.quality_rules import learn_rules

    rng = np.random.default_rng(0)
    rows = rng.random((900, 3))
    bad = (rows[:, 0] > 0.8) | ((rows[:, 1] < 0.2) & (rows[:, 2] > 0.7))
    rules = learn_rules(rows, bad, ["a", "b", "c"])
    hit = np.zeros(len(rows), dtype=bool)
    for rule in rules:
        held = np.ones(len(rows), dtype=bool)
        for name, sign, limit in rule.tests:
            v = rows[:, "abc".index(name)]
            held &= (v <= limit) if sign == "<=" else (v > limit)
        hit |= held
    assert (hit & bad).sum() >= 0.9 * bad.sum() and (hit & ~bad).sum() <= 0.02 * (~bad).sum()
    assert learn_rules(rows, rng.random(900) < 0.3, ["a", "b", "c"]) == []


def test_rules_from_labels(spark, as_query, documents, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    got = as_query("op8", documents=documents, labels=labels)
    assert got.where("kept and base_failed").isEmpty()
    good = got.join(labels.where("quality = 1"), "doc_id").where("not base_failed")
    assert good.where("kept").count() >= 0.95 * good.count()


# --- mixing -----------------------------------------------------------------------------------


def test_better_documents_are_taken_first(spark):
    """Of two grades of documents in one source the better one has more of the fractional epoch."""
    from viewmill.llm.mixing import mix_sources

    rows = [(i, "word " * 20 if i % 2 else "w#### " * 20, "s") for i in range(2000)]
    mixed = mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    taken = {r["odd"]: r["n"] for r in mixed.groupBy((F.col("id") % 2).alias("odd")).agg(F.sum("taken").alias("n")).collect()}
    assert taken[0] + taken[1] == 60_000 and taken[1] - 20_000 > 1.3 * (taken[0] - 20_000)


def test_any_grade_is_dealt_out_evenly(spark):
    """A source of tables and numbers, of the lowest grade throughout, is dealt to as many tasks as any other; results agree."""
    from viewmill.llm import mixing

    rows = [(i, f"{i % 7} #### {i} 12.5 | 77 |" if i % 3 else "plain words of a text", "n" if i % 3 else "t") for i in range(30_000)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = mixing.mix_sources(table).collect()
    stats = table.select(
        "source", F.col("doc_id").alias("id"), (F.rand(1) / mixing.quality_weight(F.col("text"))).alias("key")
    )
    ranged = mixing._in_ranges(mixing.staged(stats, "stats"), "ranged", [F.col("source"), F.col("key")])
    sizes = [r["count"] for r in ranged.groupBy("range").count().collect()]
    assert len(sizes) > 1 and max(sizes) < 2 * 30_000 / len(sizes)
    taken = {}
    for r in mixed:
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    targets = {r["source"]: round(r["target"]) for r in mixed}
    assert taken == targets and {r["id"] for r in mixed} == set(range(30_000))


def test_very_many_sources_get_weights_in_turn(spark):
    from viewmill.llm.mixing import source_targets

    names = [f"host{i:05d}" for i in range(5000)] + [None]
    sizes = spark.createDataFrame([(n, 100) for n in names], "source string, source_size long")
    got = {r["source"]: r["target"] for r in source_targets(sizes, share=0.5).collect()}
    level = 0.5 * 100 * len(names) / sum((3, 1, 2)[i % 3] for i in range(len(names)))
    assert all(abs(got[n] - (3, 1, 2)[i % 3] * level) < 1e-6 for i, n in enumerate(names))


# --- pipeline ---------------------------------------------------------------------------------


@pytest.mark.parametrize("table", ["documents", "awkward", "empty"])
def test_stages_against_brute_force(spark, request, sf_dir, table):
    import corpus_pipeline

    docs_ = request.getfixturevalue(table)
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "line_dedup", "near_dedup", "decontamination", "mixing"]
    benchmark = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    for name, stage in corpus_pipeline.STAGES:
        before = [(r["doc_id"], r["text"]) for r in docs_.collect()]
        columns, docs_ = docs_.columns, corpus_pipeline.staged(stage(spark, docs_, sf_dir), name)
        after = [(r["doc_id"], r["text"]) for r in docs_.collect()]
        if name != "mixing":
            assert docs_.columns == columns
        if name == "language_id":
            lost = [t for d, t in before if (d, t) not in set(after)]
            if table == "documents":
                # Two or three words can be equally long in all languages.
                assert len(lost) <= 0.02 * len(before)
            assert set(after) <= set(before) and {t for t in lost if not t} == {t for _, t in before if not t}
        elif name == "line_dedup":
            want = brute.line_dedup(before)
            assert brute.ordered((d, brute.sha(t or "")) for d, t in after) == brute.ordered((w[0], w[3]) for w in want)
        elif name == "near_dedup":
            # Rows that agree in id and text are one document, of which one row stays.
            kept = {b for b, w in zip(before, brute.near_duplicates(before), strict=True) if w[3]}
            assert set(after) == kept and len(after) == len(kept)
        elif name == "decontamination":
            bad = [w[-1] for w in brute.contamination(before, benchmark)]
            assert brute.ordered(after) == brute.ordered(b for b, x in zip(before, bad, strict=True) if not x)
        else:
            # Columns of the input stay, also one called like the struct.
            assert docs_.columns == [*columns, "mix_2" if "mix" in columns else "mix"]
            rows = docs_.collect()
            assert all(0 < r[-1]["taken"] <= 2 * r[-1]["size"] for r in rows)
            mixed = brute.ordered((r["doc_id"], r["text"]) for r in rows)
            full = [b for b in before if brute.words(b[1])]
            assert set(mixed) <= set(full) and (not full or mixed)
            if "mix" in columns:
                assert all(r["mix"].startswith("mix-") for r in rows)


def test_statements_in_sql(spark, sf_dir):
    """Each query that has SQL gives the same rows and types in another engine."""
    from pathlib import Path

    import duckdb

    from viewmill.llm.oracle import ORACLE_SQL
    from viewmill.llm.queries import QUERIES

    connection = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    for name, sql in ORACLE_SQL.items():
        cursor = connection.execute(sql)
        columns = [c[0] for c in cursor.description]
        got = QUERIES[name](spark, sf_dir).select(*columns).collect()
        assert brute.ordered(got) == brute.ordered(cursor.fetchall()), name
