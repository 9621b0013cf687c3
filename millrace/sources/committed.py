"""A sink that shows a job's rows all at once or not at all.

Tasks write files below a staging folder and report them; when all are done the folder is renamed into place in
one step. A failed job takes back what its tasks had written. A job has a label: what was committed under it once is
not written again, so a repeated micro-batch or a resubmitted job adds nothing.

    spark.dataSource.register(CommittedLines)
    write_committed(rows, "hdfs:///warehouse/orders", "orders-17")
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from millrace.operators.logs import rows_to_json

# Lines of one file; a task with more writes several, and holds no more than one line at a time.
FILE_LINES = 100_000
STAGING = "_staging"


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


@dataclass
class Written(WriterCommitMessage):
    """Files of one successful task attempt, by name, and their lines."""

    files: list[str]
    lines: int


class LinesWriter(DataSourceWriter):
    def __init__(self, folder: str, label: str, file_lines: int):
        self.folder, self.label, self.file_lines = folder.rstrip("/"), label, file_lines
        # Attempts of one label don't share a folder, so a job that is still dying can't disturb the next one.
        self.staged = f"{STAGING}/{label}-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[Row]) -> Written:
        system, root = opened(self.folder)
        files, lines, out = [], 0, None
        system.create_dir(f"{root}/{self.staged}", recursive=True)
        try:
            for row in iterator:
                if lines % self.file_lines == 0:
                    if out is not None:
                        out.close()
                    files.append(f"part-{uuid.uuid4().hex}.json")
                    out = system.open_output_stream(f"{root}/{self.staged}/{files[-1]}", compression=None)
                out.write(row[0].encode() + b"\n")
                lines += 1
        finally:
            if out is not None:
                out.close()
        return Written(files, lines)

    def commit(self, messages: list[Written | None]) -> None:
        system, root = opened(self.folder)
        staged, final = f"{root}/{self.staged}", f"{root}/{self.label}"
        kept = {f for m in messages if m is not None for f in m.files}
        system.create_dir(staged, recursive=True)
        # Attempts that were lost or overtaken may have left files; they are in no message.
        for info in system.get_file_info(fs.FileSelector(staged)):
            if info.base_name not in kept:
                system.delete_file(info.path)
        if system.get_file_info(final).type != fs.FileType.NotFound:
            system.delete_dir(staged)
            return
        system.move(staged, final)

    def abort(self, messages: list[Written | None]) -> None:
        system, root = opened(self.folder)
        staged = f"{root}/{self.staged}"
        if system.get_file_info(staged).type != fs.FileType.NotFound:
            system.delete_dir(staged)


class CommittedLines(DataSource):
    """Text lines (one column ``value``) into a folder, by options path, label and file_lines."""

    @classmethod
    def name(cls) -> str:
        return "committed_lines"

    def schema(self) -> str:
        return "value string"

    def writer(self, schema: StructType, overwrite: bool) -> LinesWriter:
        return LinesWriter(self.options["path"], self.options["label"], int(self.options.get("file_lines", FILE_LINES)))


def committed(spark: SparkSession, folder: str, label: str) -> bool:
    system, root = opened(folder.rstrip("/"))
    return system.get_file_info(f"{root}/{label}").type != fs.FileType.NotFound


def write_committed(df: DataFrame, folder: str, label: str, file_lines: int = FILE_LINES) -> None:
    """Rows as JSON lines below ``folder/label``. Nothing is done where the label was committed before."""
    spark = df.sparkSession
    if committed(spark, folder, label):
        return
    spark.dataSource.register(CommittedLines)
    lines = rows_to_json(df)
    lines.write.format("committed_lines").mode("append").options(path=folder, label=label, file_lines=file_lines).save()


def committed_batches(folder: str):
    """For ``foreachBatch``: each micro-batch is one label of its stream."""
    from millrace.sources.sinks import run_of

    def write(batch: DataFrame, batch_id: int) -> None:
        write_committed(batch, folder, f"run={run_of(batch.sparkSession)}-batch={batch_id}")

    return write


def read_committed(spark: SparkSession, folder: str, schema: StructType | str) -> DataFrame:
    """What was committed; Spark leaves out folders that start with an underscore."""
    return spark.read.schema(schema).option("recursiveFileLookup", "true").json(folder)
