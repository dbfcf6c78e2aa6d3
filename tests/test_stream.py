from __future__ import annotations

import json
import random

import pytest

from tests.helpers import DEFAULT_EVENT, INTERNAL, events, home, ranges, rows
from viewmill.plans.star import LoadOptions, load_star
from viewmill.schemas import DIMENSIONS, FACT_KEYS
from viewmill.sources.events import file_events, product_views
from viewmill.sources.store import StarStore
from viewmill.streaming import load as streaming
from viewmill.streaming.load import start_star_stream

FACT = "fact_product_views"


def some_events(n):
    rng = random.Random(n)
    return [
        {
            **DEFAULT_EVENT,
            "id": f"v{rng.randrange(n)}" if i % 9 == 0 else f"v{i}",
            "product_id": f"p{rng.randrange(5)}",
            "local_time": f"2024-01-0{rng.randint(1, 4)} 10:{rng.randint(10, 59)}:00",
            "collection": rng.choice(["view_product_detail", "click"]),
        }
        for i in range(n)
    ]


def write(folder, name, items):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(json.dumps(e) + "\n" for e in items))


def run(spark, store, source, checkpoint, per_trigger=None, options=LoadOptions(), remember=None):
    query = start_star_stream(
        store,
        file_events(spark, str(source), max_files_per_trigger=per_trigger),
        str(checkpoint),
        home(spark),
        INTERNAL,
        trigger={"availableNow": True},
        options=options,
        remember=remember,
    )
    query.awaitTermination()


def test_stream_equals_batch_for_any_split(spark, tmp_path):
    items = list({e["id"]: e for e in some_events(60)}.values())
    batch = StarStore(spark, str(tmp_path / "batch")).init()
    load_star(batch, product_views(events(spark, *items)), "a", home(spark), INTERNAL)
    store = StarStore(spark, str(tmp_path / "stream")).init()
    for part in range(3):
        write(tmp_path / "in", f"{part}.json", items[part::3])
    run(spark, store, tmp_path / "in", tmp_path / "offsets", per_trigger=1)
    assert store.read(FACT).select("load_id").distinct().count() == 3
    assert rows(store.table(FACT), *FACT_KEYS) == rows(batch.table(FACT), *FACT_KEYS)
    for name in DIMENSIONS:
        assert rows(store.table(name)) == rows(batch.table(name))


def test_restart_goes_on_from_the_checkpoint(spark, store, tmp_path, monkeypatch):
    seen = []
    real = streaming.load_enriched

    def watched(*args):
        done = real(*args)
        seen.append(done["views"])
        return done

    monkeypatch.setattr(streaming, "load_enriched", watched)
    write(tmp_path / "in", "1.json", [DEFAULT_EVENT, {**DEFAULT_EVENT, "id": "v2"}])
    run(spark, store, tmp_path / "in", tmp_path / "offsets")
    write(tmp_path / "in", "2.json", [{**DEFAULT_EVENT, "id": "v3"}, {**DEFAULT_EVENT, "product_id": "again"}])
    run(spark, store, tmp_path / "in", tmp_path / "offsets")
    assert seen == [2, 2]
    assert rows(store.table(FACT), "view_id") == [("v1",), ("v2",), ("v3",)]
    assert rows(store.table("dim_product"), "product_id") == [("again",), ("p1",)]


def test_failed_batch_is_delivered_again(spark, store, tmp_path, monkeypatch):
    from viewmill.plans import star

    write(tmp_path / "in", "1.json", [DEFAULT_EVENT, {**DEFAULT_EVENT, "id": "v2"}])
    real = star._load_fact

    def late_failure(*args):
        real(*args)
        raise OSError("lost after the facts were written")

    with monkeypatch.context() as patch:
        patch.setattr(star, "_load_fact", late_failure)
        with pytest.raises(Exception, match="lost after"):
            run(spark, store, tmp_path / "in", tmp_path / "offsets")
    assert store.table(FACT).count() == 0
    run(spark, store, tmp_path / "in", tmp_path / "offsets")
    assert rows(store.table(FACT), "view_id") == [("v1",), ("v2",)]
    assert store.read(FACT).select("load_id").distinct().count() == 1


def test_lost_checkpoint_stores_nothing_twice(spark, store, tmp_path):
    write(tmp_path / "in", "1.json", [DEFAULT_EVENT, {**DEFAULT_EVENT, "id": "v2"}])
    run(spark, store, tmp_path / "in", tmp_path / "offsets")
    run(spark, store, tmp_path / "in", tmp_path / "other-offsets")
    assert rows(store.table(FACT), "view_id") == [("v1",), ("v2",)]


def test_ranges_too_big_to_broadcast(spark, store, tmp_path):
    write(tmp_path / "in", "1.json", [DEFAULT_EVENT, {**DEFAULT_EVENT, "id": "v2", "ip": "9.9.9.9"}])
    run(spark, store, tmp_path / "in", tmp_path / "offsets", options=LoadOptions(broadcast_ranges=False))
    assert sorted(c for (c,) in rows(store.table("dim_location"), "country_code")) == ["HM", "UNKNOWN"]
    assert store.table(FACT).count() == 2


def test_invalid_views_do_not_stop_the_stream(spark, store, tmp_path):
    write(tmp_path / "in", "1.json", [DEFAULT_EVENT, {**DEFAULT_EVENT, "id": None}])
    run(spark, store, tmp_path / "in", tmp_path / "offsets")
    assert (store.table(FACT).count(), store.table("rejected_views").count()) == (1, 1)
    with pytest.raises(Exception, match="invalid"):
        run(spark, store, tmp_path / "in", tmp_path / "strict", options=LoadOptions(strict=True))


def test_narrowest_of_overlapping_ranges_counts(spark, store, tmp_path):
    write(tmp_path / "in", "1.json", [DEFAULT_EVENT, {**DEFAULT_EVENT, "id": "v2", "ip": "10.0.0.7"}])
    nested = ranges(spark, ("10.0.0.0", "10.0.0.9", "A"), ("10.0.0.5", "10.0.0.8", "B"))
    query = start_star_stream(
        store, file_events(spark, str(tmp_path / "in")), str(tmp_path / "o"), nested, INTERNAL, trigger={"availableNow": True}
    )
    query.awaitTermination()
    assert store.table(FACT).count() == 2
    assert sorted(c for (c,) in rows(store.table("dim_location"), "country_code")) == ["A", "B"]


def test_redelivered_events_do_not_reach_the_load(spark, store, tmp_path, monkeypatch):
    """State survives a restart; other contents under a known id pass and are judged by the load."""
    seen = []
    real = streaming.load_enriched

    def watched(*args):
        done = real(*args)
        seen.append(done["views"])
        return done

    monkeypatch.setattr(streaming, "load_enriched", watched)
    first = [{**DEFAULT_EVENT, "id": f"v{i}"} for i in range(5)]
    write(tmp_path / "in", "1.json", [*first, *first, {**DEFAULT_EVENT, "id": None}])
    run(spark, store, tmp_path / "in", tmp_path / "offsets", remember="1 hour")
    write(tmp_path / "in", "2.json", [*first, {**first[0], "product_id": "other"}, {**DEFAULT_EVENT, "id": "new"}])
    run(spark, store, tmp_path / "in", tmp_path / "offsets", remember="1 hour")
    assert [n for n in seen if n] == [6, 2]
    assert rows(store.table(FACT), "view_id") == [("new",), *[(f"v{i}",) for i in range(5)]]
    assert rows(store.table("dim_product"), "product_id") == [("other",), ("p1",)]
    assert store.table("rejected_views").count() == 1
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("RocksDBStateStoreProvider")
    assert list((tmp_path / "offsets" / "state").rglob("*.zip")) or list((tmp_path / "offsets" / "state").rglob("*.changelog"))


def test_what_is_forgotten_is_found_among_stored_ids(spark, store, tmp_path):
    write(tmp_path / "in", "1.json", [DEFAULT_EVENT])
    run(spark, store, tmp_path / "in", tmp_path / "offsets", remember="1 millisecond")
    for n in (2, 3):
        write(tmp_path / "in", f"{n}.json", [DEFAULT_EVENT, {**DEFAULT_EVENT, "id": f"v{n}"}])
        run(spark, store, tmp_path / "in", tmp_path / "offsets", remember="1 millisecond")
    assert rows(store.table(FACT), "view_id") == [("v1",), ("v2",), ("v3",)]
