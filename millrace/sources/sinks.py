"""Sinks: topics, day folders, JSON lines, keyed tables, database upserts."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.operators import cdc
from millrace.operators.logs import rows_to_json
from millrace.operators.running import latest_per_key

# Rows per database statement and attempts per batch.
JDBC_BATCH_ROWS, JDBC_ATTEMPTS, JDBC_PAUSE_SECONDS = 100, 3, 2.0


def topic_messages(df: DataFrame, topic: str | None = None, topic_column: str | None = None, key: str | None = None) -> DataFrame:
    """Rows as messages: JSON value, optional key, and the topic - one for all or one per row."""
    fields = [c for c in df.columns if c != topic_column]
    out = [F.to_json(F.struct(*fields)).alias("value")]
    if key is not None:
        out.append(F.col(key).cast("string").alias("key"))
    if topic_column is not None:
        out.append(F.col(topic_column).alias("topic"))
    elif topic is not None:
        out.append(F.lit(topic).alias("topic"))
    return df.select(*out)


def topic_sink_options(servers: str) -> dict[str, str]:
    """Producer options; an idempotent producer writes a retried message once."""
    return {
        "kafka.bootstrap.servers": servers,
        "kafka.enable.idempotence": "true",
        "kafka.acks": "all",
    }


def write_topic(messages: DataFrame, servers: str) -> None:
    messages.write.format("kafka").options(**topic_sink_options(servers)).save()


def write_by_table(df: DataFrame, folder: str, column: str = "sink_table", mode: str = "append") -> None:
    """One folder per sink table."""
    df.write.mode(mode).partitionBy(column).parquet(folder)


def write_days(df: DataFrame, folder: str, ts: str, mode: str = "append", max_rows_per_file: int = 5_000_000) -> None:
    """Day folders; rows whose time is no number go to ``day=error_bucket``.

    Tasks write their own files, so a day with most of the rows is not pulled into one task; the
    row limit splits large files.
    """
    cdc.day_bucket(df, ts).write.mode(mode).partitionBy("day").option(
        "maxRecordsPerFile", max_rows_per_file
    ).parquet(folder)


def write_json_lines(df: DataFrame, folder: str, mode: str = "append") -> None:
    rows_to_json(df).write.mode(mode).text(folder)


def insert_into(df: DataFrame, table: str) -> None:
    """Append to a catalog table, by column name; the table is created if it does not exist."""
    df.write.mode("append").saveAsTable(table)


def run_of(spark: SparkSession) -> str:
    """Name of the stream that is writing: the id in its checkpoint, which a restart keeps; "own" outside one."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "own"


@dataclass(frozen=True)
class KeyedTable:
    """Latest row per key over a folder of runs and batches.

    Every batch is reduced to one row per key and written below its run (see :func:`run_of`), replacing an
    earlier attempt of the same batch of the same run: a repeated batch changes nothing, and another stream
    or one that starts anew leaves what is there. Reading takes the latest row per key over all batches; at
    equal order the later run by name, then the later batch. A read costs as many files as were written since
    the last :meth:`rewrite`, which writes the merged rows to a new folder.
    """

    folder: str
    key: tuple[str, ...]
    order: tuple[str, ...]

    def write_batch(self, batch: DataFrame, batch_id: int) -> None:
        latest = latest_per_key(batch, list(self.key), list(self.order))
        latest.write.mode("overwrite").parquet(f"{self.folder}/run={run_of(batch.sparkSession)}/batch={batch_id}")

    def read(self, spark: SparkSession) -> DataFrame:
        rows = spark.read.parquet(self.folder)
        order = [*self.order, "run", "batch"]
        return latest_per_key(rows.withColumn("run", F.col("run").cast("string")), list(self.key), order).drop("run", "batch")

    def rewrite(self, spark: SparkSession, folder: str) -> KeyedTable:
        merged = KeyedTable(folder, self.key, self.order)
        self.read(spark).write.mode("errorifexists").parquet(f"{folder}/run=0/batch=-1")
        return merged


def upsert_statement(table: str, columns: list[str], key: list[str], mark: str = "%s") -> str:
    """``insert … on duplicate key update`` over the given columns."""
    names = ", ".join(columns)
    marks = ", ".join([mark] * len(columns))
    changes = ", ".join(f"{c} = VALUES({c})" for c in columns if c not in key)
    return f"INSERT INTO {table} ({names}) VALUES ({marks}) ON DUPLICATE KEY UPDATE {changes}"


def write_database(
    df: DataFrame, connect: Callable[[], object], statement: str, key: list[str] = (), order: list[str] = ()
) -> None:
    """Run an upsert statement for all rows, in small batches, from the tasks.

    ``connect`` opens a DB-API connection inside a task. Tasks write in any order, so with ``key`` and
    ``order`` the rows are first reduced to the latest one per key. A failed batch is rolled back and tried
    again; upserts make repeats harmless.
    """
    columns = df.columns
    if key:
        df = latest_per_key(df, list(key), list(order)).select(*columns)

    def write(rows) -> None:
        connection = connect()
        try:
            pending = []
            for row in rows:
                pending.append(tuple(row[c] for c in columns))
                if len(pending) == JDBC_BATCH_ROWS:
                    _execute(connection, statement, pending)
                    pending = []
            if pending:
                _execute(connection, statement, pending)
        finally:
            connection.close()

    df.foreachPartition(write)


def _execute(connection, statement: str, rows: list[tuple]) -> None:
    for attempt in range(1, JDBC_ATTEMPTS + 1):
        try:
            connection.cursor().executemany(statement, rows)
            connection.commit()
            return
        except Exception:
            connection.rollback()
            if attempt == JDBC_ATTEMPTS:
                raise
            time.sleep(JDBC_PAUSE_SECONDS)
