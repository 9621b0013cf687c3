"""Readers and writers, on folders; connector options as text."""

from __future__ import annotations

import json
import os

from pyspark.sql import functions as F

from millrace.session import checkpoint_dir
from millrace.sources import readers, sinks
from millrace.streaming import jobs


def test_topic_options():
    options = readers.topic_options("h:1", "t", readers.LATEST, 100)
    assert options["subscribe"] == "t" and options["startingOffsets"] == "latest" and options["maxOffsetsPerTrigger"] == "100"
    assert sinks.topic_sink_options("h:1")["kafka.enable.idempotence"] == "true"


def test_changelog_from_text(spark):
    lines = ['{"op":"u","before":{"id":1,"a":"1.50"},"after":{"id":1,"a":"2.00"},"source":{"table":"t"},"ts_ms":7}', None]
    row = readers.changelog(spark.createDataFrame([(v,) for v in lines], "value string")).collect()
    assert len(row) == 1 and row[0].after == {"id": "1", "a": "2.00"} and row[0].source["table"] == "t"


def test_snapshot_then_log(spark):
    snapshot = spark.createDataFrame([(1, "x")], "id int, name string")
    log = readers.changelog(spark.createDataFrame([('{"op":"d","before":{"id":"1"},"source":{"table":"t"},"ts_ms":9}',)], "value string"))
    both = readers.changelog_with_snapshot(spark, snapshot, "shop", "t", log).orderBy("ts_ms").collect()
    assert [(r.op, r.ts_ms) for r in both] == [("r", 0), ("d", 9)] and both[0].after == {"id": "1", "name": "x"}


def test_json_table_view(spark):
    values = spark.createDataFrame([('{"page":{"item":"tv"},"ts":1}',)], "value string")
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("page", T.MapType(T.StringType(), T.StringType())), T.StructField("ts", T.LongType())])
    readers.json_table(values, schema, "page_log")
    assert spark.sql("select page['item'] as kw from page_log").collect()[0].kw == "tv"


def test_jdbc_options():
    options = readers.jdbc_split_options("u", "t", "a", "b", "id", 0, 10, 4)
    assert options["partitionColumn"] == "id" and options["numPartitions"] == "4"


def test_camel_columns(spark):
    assert readers.camel_columns(spark.createDataFrame([(1,)], "sink_row_key int")).columns == ["sinkRowKey"]


def test_text_lines_stream(spark, tmp_path):
    source, out = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    (source / "a.log").write_text("one\ntwo\n")
    go = lambda: jobs.run_available(
        readers.text_lines(spark, str(source)), "lines", jobs.append_batch(str(out)), location=str(tmp_path / "cp")
    )
    go()
    (source / "b.log").write_text("three\n")
    go()
    assert sorted(r.value for r in spark.read.parquet(str(out)).collect()) == ["one", "three", "two"]


def test_messages(spark):
    df = spark.createDataFrame([("t1", 1, "x")], "sink_table string, id int, name string")
    row = sinks.topic_messages(df, topic_column="sink_table", key="id").collect()[0]
    assert (row.topic, row.key, json.loads(row.value)) == ("t1", "1", {"id": 1, "name": "x"})
    assert sinks.topic_messages(df, topic="all").collect()[0].topic == "all"


def test_day_folders(spark, tmp_path):
    df = spark.createDataFrame([("1700000000",), ("1700000000000",), ("bad",), (None,)], "ts string")
    sinks.write_days(df, str(tmp_path / "days"), "ts")
    found = sorted(n for n in os.listdir(tmp_path / "days") if n.startswith("day="))
    assert found == ["day=20231114", "day=error_bucket"]
    assert spark.read.parquet(str(tmp_path / "days")).count() == 4


def test_json_lines_and_tables(spark, tmp_path):
    df = spark.createDataFrame([(1, "x")], "curDate int, name string")
    sinks.write_json_lines(df, str(tmp_path / "json"))
    assert spark.read.text(str(tmp_path / "json")).collect()[0].value == '{"cur_date":1,"name":"x"}'
    sinks.write_by_table(df.withColumn("sink_table", F.lit("a")), str(tmp_path / "by"))
    assert os.path.isdir(tmp_path / "by" / "sink_table=a")


def _file_database(path):
    """Stands for a database: writes rows to a file, fails on its first statement.

    Built inside a function so that the tasks get the classes by value.
    """
    import json as js

    class Cursor:
        def __init__(self, fail):
            self.fail = fail

        def executemany(self, statement, rows):
            if self.fail:
                raise OSError("lost")
            with open(path, "a") as f:
                f.writelines(js.dumps(r) + "\n" for r in rows)
                f.write(f"# {len(rows)}\n")

    class Connection:
        calls = 0

        def cursor(self):
            self.calls += 1
            return Cursor(self.calls == 1)

        def commit(self):
            pass

        rollback = close = commit

    return Connection


def test_database_writes_in_batches(spark, tmp_path):
    path = str(tmp_path / "rows")
    statement = sinks.upsert_statement("ads", ["id", "n"], ["id"])
    assert statement == "INSERT INTO ads (id, n) VALUES (%s, %s) ON DUPLICATE KEY UPDATE n = VALUES(n)"
    df = spark.range(250).select("id", (F.col("id") * 2).alias("n")).coalesce(1)
    sinks.write_database(df, _file_database(path), statement)
    lines = open(path).read().splitlines()
    assert [x for x in lines if x.startswith("#")] == ["# 100", "# 100", "# 50"]
    assert len({x for x in lines if not x.startswith("#")}) == 250


def test_checkpoint_folder_comes_from_the_session(spark):
    class Conf:
        def get(self, key, default):
            return {"spark.checkpoint.dir": "/shared/checkpoints"}.get(key, default)

    class Session:
        conf = Conf()

    assert checkpoint_dir(Session()) == "/shared/checkpoints"
    assert jobs.checkpoint_location(Session(), "x") == "/shared/checkpoints/streams/x"
    assert os.path.isdir(checkpoint_dir(spark))


def test_insert_into_a_table(spark, tmp_path):
    spark.sql(f"CREATE TABLE millrace_sink (id INT, name STRING) USING parquet LOCATION '{tmp_path / 'sink'}'")
    try:
        df = spark.createDataFrame([("x", 1)], "name string, id int")
        sinks.insert_into(df, "millrace_sink")
        sinks.insert_into(df, "millrace_sink")
        assert [tuple(r) for r in spark.table("millrace_sink").collect()] == [(1, "x"), (1, "x")]
    finally:
        spark.sql("DROP TABLE millrace_sink")
