from __future__ import annotations

import pytest

from tests.llm import brute


@pytest.fixture(scope="session")
def awkward(spark):
    """The awkward cases, with extra columns that have the names of results and inner columns."""
    extra = ["id", "mark", "row", "n_words", "size", "label", "kept_text", "mix"]
    rows = [(*r, *[f"{c}-{i}" for c in extra]) for i, r in enumerate(brute.awkward())]
    schema = brute.DOCUMENTS + "".join(f", `{c}` string" for c in extra)
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], brute.DOCUMENTS)


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def as_query(spark, tmp_path_factory):
    """Runs a registered query over tables that a test gives."""
    from viewmill.llm.queries import QUERIES

    def run(name, **tables):
        folder = tmp_path_factory.mktemp("tables")
        for table, df in tables.items():
            df.write.parquet(f"{folder}/{table}.parquet")
        query = next(q for n, q in QUERIES.items() if n == name or n.startswith(f"{name}_"))
        return query(spark, str(folder))

    return run
