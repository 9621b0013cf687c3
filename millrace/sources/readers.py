"""Sources: topics, changelog and log folders, database snapshots, dimension tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from millrace import schemas

EARLIEST, LATEST = "earliest", "latest"

# Partitions of a topic at most, for the position of a message in one number.
PARTITIONS = 65_536


def topic_options(
    servers: str, topic: str, offsets: str = EARLIEST, per_trigger: int | None = None, skip_lost: bool = False
) -> dict[str, str]:
    """Options of a topic source. The topic's position is kept in the query's checkpoint.

    Positions that the topic no longer holds end the query, unless ``skip_lost`` asks to go on without them.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": offsets,
        "failOnDataLoss": "false" if skip_lost else "true",
    }
    if per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(per_trigger)
    return options


def topic_values(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Message values of a topic as text, with their position.

    Offsets repeat in every partition, so ``seq`` is made of both: unique in the topic, and in the order of
    arrival within a partition.

    Needs the Kafka connector package on the cluster. Values of tombstones are null; drop them with
    :func:`without_tombstones`.
    """
    raw = spark.readStream.format("kafka").options(**options).load()
    return raw.select(
        F.col("value").cast("string").alias("value"), "partition", "offset", position("partition", "offset").alias("seq")
    )


def position(partition: str, offset: str) -> Column:
    """A unique, growing number out of a message's offset and partition."""
    return F.col(offset).cast("bigint") * PARTITIONS + F.col(partition).cast("bigint")


def without_tombstones(values: DataFrame) -> DataFrame:
    return values.where(F.col("value").isNotNull())


def json_table(values: DataFrame, schema: T.StructType, view: str | None = None) -> DataFrame:
    """Messages as typed columns, optionally under a view name for SQL users.

    Malformed messages are left out; :func:`malformed` gives them. A position (``seq``) stays beside the columns.
    """
    kept = [c for c in ("seq",) if c in values.columns and c not in schema.fieldNames()]
    table = _parsed(values, schema).where(~_broken()).select("r.*", *kept)
    if view is not None:
        table.createOrReplaceTempView(view)
    return table


def _parsed(values: DataFrame, schema: T.StructType) -> DataFrame:
    marked = T.StructType([*schema.fields, T.StructField("__bad", T.StringType())])
    read = values.withColumn("__r", F.from_json("value", marked, {"columnNameOfCorruptRecord": "__bad"}))
    plain = F.struct(*[F.col("__r")[f.name].alias(f.name) for f in schema.fields])
    return read.withColumn("r", plain).withColumn("__broken", F.col("__r").isNull() | F.col("__r.__bad").isNotNull())


def _broken() -> Column:
    return F.col("__broken") & F.col("value").isNotNull()


def malformed(values: DataFrame, schema: T.StructType) -> DataFrame:
    """The messages that :func:`json_table` leaves out because their text is no such record."""
    return _parsed(values, schema).where(_broken()).select(*values.columns)


def text_lines(spark: SparkSession, folder: str, files_per_trigger: int | None = None) -> DataFrame:
    """New lines of a folder as a stream; the source remembers which files it has seen."""
    reader = spark.readStream.format("text")
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(folder)


def folder_stream(spark: SparkSession, folder: str, schema: T.StructType, fmt: str = "parquet", files_per_trigger: int | None = None) -> DataFrame:
    """Typed records of a folder as a stream."""
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(folder)


def changelog(values: DataFrame) -> DataFrame:
    """Change records (op, before, after, source, ts_ms) from their JSON text; decimals stay text.

    With a topic's values the records carry their position as ``seq``. Malformed texts are left out here and
    given by :func:`malformed` with ``schemas.CHANGE``.
    """
    return json_table(without_tombstones(values), schemas.CHANGE)


def changelog_with_snapshot(spark: SparkSession, snapshot: DataFrame, database: str, table: str, changes: DataFrame) -> DataFrame:
    """Initial rows of a table as ``r`` records in front of its changelog (batch frames)."""
    entries = [c for name in snapshot.columns for c in (F.lit(name), F.col(name).cast("string"))]
    initial = snapshot.select(
        F.lit("r").alias("op"),
        F.lit(None).cast("map<string,string>").alias("before"),
        F.create_map(*entries).alias("after"),
        F.create_map(F.lit("db"), F.lit(database), F.lit("table"), F.lit(table)).alias("source"),
        F.lit(0).cast("bigint").alias("ts_ms"),
    )
    # Snapshot rows stand before every position of the log.
    return initial.withColumn("seq", F.lit(-1).cast("bigint")).unionByName(changes) if "seq" in changes.columns else initial.unionByName(changes)


def chunked_snapshot(
    spark: SparkSession, read: Callable[[int, int], DataFrame], log_position: Callable[[], int], bounds: list[int], folder: str
) -> tuple[DataFrame, DataFrame]:
    """A table read chunk by chunk while it changes, with the log's position before and after each chunk.

    ``read`` gives the rows with key from ``bounds[n]`` up to, but not, ``bounds[n + 1]``; each chunk is read once, into
    its own folder below ``folder``. Returns the rows with their chunk, and (chunk, low, high): what
    :func:`millrace.operators.temporal.snapshot_handover` takes. A chunk that is read again after a failure gets
    new marks and replaces its folder.
    """
    marks = []
    for n, (lower, upper) in enumerate(zip(bounds, bounds[1:])):
        low = log_position()
        read(lower, upper).write.mode("overwrite").parquet(f"{folder}/chunk={n}")
        marks.append((n, low, log_position()))
    return spark.read.parquet(folder), spark.createDataFrame(marks, "chunk bigint, low bigint, high bigint")


def jdbc_options(url: str, query: str, user: str, password: str, fetch: int = 10_000) -> dict[str, str]:
    return {"url": url, "query": query, "user": user, "password": password, "fetchsize": str(fetch)}


def jdbc_split_options(url: str, table: str, user: str, password: str, column: str, lower: int, upper: int, parts: int) -> dict[str, str]:
    """Options of a parallel table read, split on a numeric column."""
    return {
        "url": url,
        "dbtable": table,
        "user": user,
        "password": password,
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(parts),
    }


def jdbc_snapshot(spark: SparkSession, options: dict[str, str], snake_to_camel: bool = False) -> DataFrame:
    """Rows of a database query. Needs the database's driver on the cluster."""
    rows = spark.read.format("jdbc").options(**options).load()
    return camel_columns(rows) if snake_to_camel else rows


def camel_columns(df: DataFrame) -> DataFrame:
    """Column names from snake_case to camelCase."""
    def camel(name: str) -> str:
        first, *rest = name.split("_")
        return first + "".join(w.capitalize() for w in rest)

    return df.select(*[F.col(c).alias(camel(c)) for c in df.columns])


def dimension(spark: SparkSession, folder: str) -> DataFrame:
    """A dimension table. In a stream-static join Spark lists the folder anew for every micro-batch
    when the frame is built inside ``foreachBatch``, so changed rows are seen."""
    return spark.read.parquet(folder)
