from __future__ import annotations

import json

import pytest

from tests.helpers import DEFAULT_EVENT, events, rows
from viewmill.schemas import EVENT_FIELDS, TABLES
from viewmill.sources.events import (
    decode_payload,
    file_events,
    flatten_events,
    kafka_events,
    kafka_options,
    parse_events,
    preview,
    product_views,
    views_from_records,
)
from viewmill.sources.jdbc import jdbc_options
from viewmill.sources.store import StarStore


def records(spark, *payloads):
    return spark.createDataFrame([(p.encode() if p is not None else None,) for p in payloads], "value binary")


def test_bad_json_is_dropped_and_numbers_become_text(spark):
    event = {**DEFAULT_EVENT, "product_id": 7}
    parsed = flatten_events(parse_events(decode_payload(records(spark, "{bad", json.dumps(event), None))))
    assert parsed.count() == 3
    assert rows(product_views(parsed), "product_id") == [("7",)]


def test_kind_filter(spark):
    raw = events(spark, {}, {"collection": None}, {"collection": "click"}, {"collection": "VIEW_PRODUCT_DETAIL"})
    found = product_views(raw)
    assert found.columns == ["view_id", *EVENT_FIELDS[1:]]
    assert found.count() == 1


def test_text_search_before_parsing_loses_nothing(spark):
    plain = json.dumps(DEFAULT_EVENT)
    escaped = plain.replace("view_product_detail", "view\\u005fproduct_detail")
    elsewhere = json.dumps({**DEFAULT_EVENT, "collection": "click", "current_url": "/view_product_detail"})
    source = records(spark, plain, escaped, elsewhere, "{bad view_product_detail", None)
    everything = product_views(flatten_events(parse_events(decode_payload(source))))
    found = views_from_records(source)
    assert rows(found) == rows(everything)
    assert found.count() == 2


def test_files_have_the_shape_of_records(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps(DEFAULT_EVENT) + "\n{bad\n")
    batch = file_events(spark, str(tmp_path), streaming=False)
    assert batch.columns == ["value"]
    assert rows(views_from_records(batch), "view_id") == [("v1",)]
    assert file_events(spark, str(tmp_path), max_files_per_trigger=1).isStreaming


def test_preview_is_ordered(spark):
    df = spark.createDataFrame([(3,), (1,), (2,)], "n int")
    assert rows(preview(df, 2, "n")) == [(1,), (2,)]


def test_kafka_options():
    options = kafka_options("host:1", "events", security={"sasl.mechanism": "PLAIN"})
    assert options == {
        "kafka.bootstrap.servers": "host:1",
        "subscribe": "events",
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
        "kafka.sasl.mechanism": "PLAIN",
    }
    limited = kafka_options("host:1", "events", max_offsets_per_trigger=1000, min_partitions=64)
    assert (limited["maxOffsetsPerTrigger"], limited["minPartitions"]) == ("1000", "64")


@pytest.mark.parametrize("streaming", [True, False])
def test_kafka_reader_gets_the_options(streaming):
    """The connector is not part of Spark itself, so the reader is watched instead."""

    class Reader:
        def format(self, name):
            self.name = name
            return self

        def options(self, **given):
            self.given = given
            return self

        def load(self):
            return self

    class Session:
        read, readStream = Reader(), Reader()

    found = kafka_events(Session, kafka_options("host:1", "events"), streaming)
    assert found is (Session.readStream if streaming else Session.read)
    assert (found.name, found.given["subscribe"]) == ("kafka", "events")


def test_jdbc_options():
    assert jdbc_options("jdbc:x", "t", {"user": "u"}) == {"url": "jdbc:x", "dbtable": "t", "user": "u"}



def test_init_creates_all_tables_once(spark, store):
    for name, table in TABLES.items():
        assert store.read(name).schema == table.stored_schema or set(store.read(name).columns) == set(
            table.stored_schema.names
        )
        assert store.read(name).count() == 0
    time = spark.createDataFrame([(5, 0, 5)], "sk_time int, hour int, minute int")
    store.add_rows("dim_time", time, "one")
    StarStore(spark, store.root).init()
    assert rows(store.table("dim_time")) == [(5, 0, 5)]
    assert store.read_days("fact_product_views", [20240101]).count() == 0
