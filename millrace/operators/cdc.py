"""Database changelog: flattening, row images, routing and keyed tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions import keys, times
from millrace.operators.running import latest_per_key
from millrace.operators.temporal import lookup_as_of


def of_table(changes: DataFrame, table: str) -> DataFrame:
    return changes.where(F.col("source")["table"] == table)


def status_became(changes: DataFrame, table: str, field: str, after: str, before: str | None = None) -> DataFrame:
    """Updates of a table whose status field became ``after``, from ``before`` or any known value."""
    old, new = F.col("before")[field], F.col("after")[field]
    was = old.isNotNull() if before is None else old == before
    return of_table(changes, table).where((F.col("op") == "u") & was & (new == after))


def image(op: str = "op", before: str = "before", after: str = "after") -> Column:
    """The row a change is about: the new one, or the old one for a delete."""
    return F.when(F.col(op) == "d", F.col(before)).otherwise(F.coalesce(F.col(after), F.col(before)))


def row_image(changes: DataFrame) -> DataFrame:
    return changes.select(
        "op", F.col("source")["table"].alias("table_name"), image().alias("image"), "ts_ms"
    )


def flatten(changes: DataFrame, id_field: str = "id", extra: list[Column] = ()) -> DataFrame:
    """One flat record per change, named by row id and time."""
    return changes.select(
        F.concat_ws("_", image()[id_field], F.col("ts_ms").cast("string")).alias("id_ts"),
        "op",
        F.col("source")["db"].alias("database"),
        F.col("source")["table"].alias("table_name"),
        keys.map_text(F.col("before")).alias("before"),
        keys.map_text(F.col("after")).alias("after"),
        F.col("ts_ms").cast("string").alias("ts"),
        *extra,
    )


def audit_latest(changes: DataFrame) -> DataFrame:
    """Audit table of changes, one row per table and record name; a repeated change overwrites.

    Changes of one row in the same millisecond share a name. The one that is later in the log stays, by
    ``seq`` where the changes carry it; without it a delete is taken to be the last and a snapshot row the
    first, as nothing is done to a row that is gone or not yet there.
    """
    flat = flatten(changes)
    turn = F.when(F.col("op") == "d", 3).when(F.col("op") == "u", 2).when(F.col("op") == "c", 1).otherwise(0)
    at = F.col("seq") if "seq" in changes.columns else F.lit(0)
    placed = flatten(changes, extra=[at.cast("bigint").alias("__at")]).withColumn("__turn", turn)
    latest = latest_per_key(placed, ["table_name", "id_ts"], ["__at", "__turn", "before", "after", "database"])
    return latest.select(*flat.columns)


def config_current(changes: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Routing configuration in force: the latest entry per source table, deleted ones gone."""
    return latest_per_key(changes, [key], order).where(F.col("op") != "d")


def route_fact(changes: DataFrame, config: DataFrame) -> DataFrame:
    """Send each change to the sink table configured for its source, with only the wanted columns.

    Deletes carry no new row and are skipped. The configuration has one row per source table.
    """
    wanted = config.select(
        F.col("source_table").alias("__source"), "sink_table", F.split("sink_columns", ",").alias("__columns")
    )
    routed = changes.where((F.col("op") != "d") & F.col("after").isNotNull()).join(
        wanted, F.col("source")["table"] == F.col("__source")
    )
    return routed.select(
        "sink_table",
        keys.keep_keys(F.col("after"), F.col("__columns")).alias("payload"),
        F.col("ts_ms").alias("ts"),
    )


def route_fact_as_of(changes: DataFrame, history: DataFrame, slice_by: Column) -> DataFrame:
    """:func:`route_fact` by the configuration that was in force at each change's own time.

    ``history`` has source_table, sink_table, sink_columns, op (``d`` ends the entry) and ts. Changes of tables that
    had no entry at their time go nowhere. An entry of the change's own time counts. ``slice_by`` cuts time (``ts``), so
    a table with most of the changes is many tasks.
    """
    new = changes.where((F.col("op") != "d") & F.col("after").isNotNull()).select(
        F.col("source")["table"].alias("source_table"), "after", F.col("ts_ms"), F.timestamp_millis("ts_ms").alias("at_ts")
    )
    known = lookup_as_of(
        new, history, {"source_table": "source_table"}, "at_ts", "ts", ["op", "sink_table", "sink_columns"],
        {"sink_table": "sink_table", "sink_columns": "__columns"}, slice_by, F.col("op") == "d",
    )
    return known.where(F.col("sink_table").isNotNull()).select(
        "sink_table", keys.keep_keys(F.col("after"), F.split("__columns", ",")).alias("payload"), F.col("ts_ms").alias("ts")
    )


def dim_latest(changes: DataFrame, config: DataFrame) -> DataFrame:
    """Dimension rows by configuration: pruned, keyed by the md5 of the row key, latest per key."""
    wanted = config.select(
        F.col("source_table").alias("__source"),
        "sink_table",
        F.split("sink_columns", ",").alias("__columns"),
        F.col("sink_row_key").alias("__key"),
    )
    kept = changes.where((F.col("op") != "d") & F.col("after").isNotNull()).join(
        wanted, F.col("source")["table"] == F.col("__source")
    )
    rows = kept.select(
        "sink_table",
        F.md5(F.element_at(F.col("after"), F.col("__key"))).alias("row_key"),
        keys.map_text(keys.keep_keys(F.col("after"), F.col("__columns"))).alias("payload"),
        "ts_ms",
    )
    return latest_per_key(rows, ["sink_table", "row_key"], ["ts_ms", "payload"])


def dim_apply_changes(table: DataFrame, changes: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Apply puts and deletes to a keyed table.

    ``changes`` has ``op`` (d deletes, all else puts), the key, the order columns and any of the
    table's columns. The last change of a key decides; empty values are not written, so the table
    keeps what it has. Puts of unknown keys become new rows.
    """
    last = latest_per_key(changes, [key], order)
    written = [c for c in table.columns if c != key and c in changes.columns]
    puts = last.select(
        F.col(key),
        F.col("op").alias("__op"),
        *[F.when(F.col(c).cast("string") != "", F.col(c)).alias(f"__new_{c}") for c in written],
    )
    merged = table.join(puts, [key], "full").where(~F.col("__op").eqNullSafe("d"))
    return merged.select(
        *[
            F.coalesce(F.col(f"__new_{c}"), F.col(c)).alias(c) if c in written else F.col(c)
            for c in table.columns
        ]
    )


def dim_lookup(table: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """Rows of a keyed table whose key is asked for."""
    return table.join(wanted.select(key), [key], "left_semi")


def upsert_latest(target: DataFrame, updates: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The keyed table after the updates: latest row per key over both."""
    return latest_per_key(target.unionByName(updates), key, order)


def day_bucket(df: DataFrame, ts: str, column: str = "day") -> DataFrame:
    """Day partition of each row; a time that is no number goes to ``error_bucket``."""
    at = times.millis_to_timestamp(times.epoch_millis(F.col(ts)))
    return df.withColumn(column, F.coalesce(times.day_stamp(at), F.lit("error_bucket")))
