from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

from millrace.plans.views import Inputs  # noqa: E402
from millrace.session import local_session  # noqa: E402

SMALL = os.environ.get("MILLRACE_TEST_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder() -> str:
    return SMALL


@pytest.fixture(scope="session")
def inputs(spark, folder) -> Inputs:
    return Inputs(spark, folder)


def rows(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def same():
    """Check that two frames hold the same rows, whatever their order."""

    def check(left, right) -> None:
        assert sorted(left.columns) == sorted(right.columns)
        assert rows(left.select(*right.columns)) == rows(right)

    return check


@pytest.fixture
def feed(spark, tmp_path):
    """Write a frame as several files in order and read it back as a stream, one file per batch."""

    def build(df, order: list[str], batches: int = 3):
        source = str(tmp_path / f"feed-{len(list(tmp_path.iterdir()))}")
        ordered = [r for r in df.orderBy(*order).collect()]
        size = -(-len(ordered) // batches)
        for n in range(batches):
            part = spark.createDataFrame(ordered[n * size : (n + 1) * size], df.schema)
            part.coalesce(1).write.mode("append").parquet(source)
        from millrace.sources.readers import folder_stream

        return folder_stream(spark, source, df.schema, files_per_trigger=1)

    return build


@pytest.fixture
def run(spark, tmp_path):
    """Run a stream over what is there and read back what it wrote."""

    def go(stream, name: str, mode: str = "append"):
        from millrace.streaming import jobs

        out = str(tmp_path / f"out-{name}")
        jobs.run_available(
            stream, name, jobs.append_batch(out), mode, wait=120, location=str(tmp_path / f"cp-{name}")
        )
        return spark.read.schema(stream.schema).parquet(out).select(*stream.columns)

    return go
