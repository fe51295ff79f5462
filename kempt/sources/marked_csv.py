"""Ordered CSV export with a byte-order mark: a Python data source writer.

Spark's own CSV writer puts no mark, and a mark or a header in every part file
would stand in the middle once the parts are joined.  Here the mark and the
header are written once, at the start of the first part; the parts, one after
the other, are the file.

Every task attempt writes a file of its own under ``_attempts`` and returns its
name as the commit message.  Only the messages of the successful attempts reach
``commit``, which moves these files to their final names, so that a task that
was retried, or ran twice, leaves no second part.  A ``_SUCCESS`` file comes
last.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from kempt.sources.snapshot import normalise_integers

BYTE_ORDER_MARK = "\ufeff"
FORMAT = "kempt_marked_csv"


def line(values: Sequence[str | None]) -> str:
    """A CSV line: NULL is nothing, the empty text is quoted, quotes are doubled."""
    out = []
    for v in values:
        if v is None:
            out.append("")
        elif v == "" or any(c in v for c in '",\r\n') or v != v.strip():
            out.append('"' + v.replace('"', '""') + '"')
        else:
            out.append(v)
    return ",".join(out) + "\n"


def _filesystem(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(f"file://{path}" if path.startswith("/") else path)


@dataclass
class Written(WriterCommitMessage):
    """One attempt's file."""

    part: int
    name: str
    rows: int


class MarkedCsvWriter(DataSourceWriter):
    """Writes attempts, and commits those of the messages."""

    def __init__(self, path: str, columns: Sequence[str]):
        self.path, self.columns = path, list(columns)

    def _head(self) -> bytes:
        return (BYTE_ORDER_MARK + line(self.columns)).encode()

    def write(self, iterator: Iterator) -> Written:
        fs, root = _filesystem(self.path)
        part = TaskContext.get().partitionId()
        name, rows = f"part-{part:05d}-{uuid.uuid4().hex}", 0
        fs.create_dir(f"{root}/_attempts", recursive=True)
        with fs.open_output_stream(f"{root}/_attempts/{name}") as out:
            if part == 0:
                out.write(self._head())
            for row in iterator:
                out.write(line(row).encode())
                rows += 1
        return Written(part, name, rows)

    def commit(self, messages: list[Written | None]) -> None:
        fs, root = _filesystem(self.path)
        done = sorted((m for m in messages if m is not None), key=lambda m: m.part)
        fs.create_dir(root, recursive=True)
        for m in done:
            fs.move(f"{root}/_attempts/{m.name}", f"{root}/part-{m.part:05d}.csv")
        if not any(m.part == 0 for m in done):  # a table without partitions
            with fs.open_output_stream(f"{root}/part-00000.csv") as out:
                out.write(self._head())
        self._drop_attempts(fs, root)
        with fs.open_output_stream(f"{root}/_SUCCESS"):
            pass

    def abort(self, messages: list[Written | None]) -> None:
        fs, root = _filesystem(self.path)
        self._drop_attempts(fs, root)

    @staticmethod
    def _drop_attempts(fs, root: str) -> None:
        from pyarrow.fs import FileType

        if fs.get_file_info(f"{root}/_attempts").type == FileType.Directory:
            fs.delete_dir(f"{root}/_attempts")


class MarkedCsv(DataSource):
    """The format's entry point."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema, overwrite: bool) -> MarkedCsvWriter:
        return MarkedCsvWriter(self.options["path"], [f.name for f in schema.fields])


def export_marked_csv(df: DataFrame, path: str, key: Sequence[str], integer_columns: Sequence[str] = ()) -> None:
    """Export ``df`` in key order to the fresh folder ``path`` on shared storage.

    Values are rendered by Spark.  The sort is by range, so part i holds lower
    keys than part i + 1; concatenate ``part-*.csv`` for one file.
    """
    out = normalise_integers(df, integer_columns) if integer_columns else df
    out = out.orderBy(*key)
    text = out.select(*[F.col(c).cast("string").alias(c) for c in out.columns])
    df.sparkSession.dataSource.register(MarkedCsv)
    text.write.format(FORMAT).mode("append").option("path", path).save()
