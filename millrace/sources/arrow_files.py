"""Arrow IPC (Feather) files and streams as a Spark data source, read and written batch by batch.

``spark.read.format("arrow_ipc").schema(...).load(folder)`` reads every ``.arrow``,
``.feather`` (file format) and ``.arrows`` (stream format) file below a folder, one
partition a file, and only the columns of the schema.  ``df.write.format("arrow_ipc")``
writes the file format, or the stream format with ``option("layout", "stream")``.
"""

from __future__ import annotations

import posixpath
import uuid
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

ENDINGS = (".arrow", ".feather", ".arrows")


def _place(uri: str):
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return (fs.LocalFileSystem(), uri) if "://" not in uri else fs.FileSystem.from_uri(uri)


class ArrowReader(DataSourceReader):
    def __init__(self, path: str, schema):
        self.path, self.schema = path, schema

    def partitions(self):
        from pyarrow import fs

        system, path = _place(self.path)
        found = system.get_file_info(fs.FileSelector(path, recursive=True))
        return [InputPartition(x.path) for x in found if x.path.endswith(ENDINGS) and not x.base_name.startswith(("_", "."))] or [InputPartition("")]

    def read(self, partition):
        from pyspark.sql.pandas.types import to_arrow_schema

        if not partition.value:
            return
        want = to_arrow_schema(self.schema)
        system, _ = _place(self.path)
        with system.open_input_file(partition.value) as f:
            reader = pa.ipc.open_stream(f) if partition.value.endswith(".arrows") else pa.ipc.open_file(f)
            batches = reader if partition.value.endswith(".arrows") else (reader.get_batch(i) for i in range(reader.num_record_batches))
            for batch in batches:
                yield pa.RecordBatch.from_arrays([batch.column(n.name).cast(n.type) for n in want], schema=want)


@dataclass
class Part(WriterCommitMessage):
    attempt: str | None
    final: str | None


class ArrowWriter(DataSourceArrowWriter):
    def __init__(self, path: str, stream: bool, overwrite: bool):
        self.path, self.stream, self.overwrite = path, stream, overwrite

    def write(self, iterator):
        system, path = _place(self.path)
        out, writer, name = None, None, f"part-{uuid.uuid4().hex}.{'arrows' if self.stream else 'arrow'}"
        attempt = posixpath.join(path, f"_{name}")
        for batch in iterator:
            if writer is None:
                system.create_dir(path, recursive=True)
                out = system.open_output_stream(attempt)
                writer = pa.ipc.new_stream(out, batch.schema) if self.stream else pa.ipc.new_file(out, batch.schema)
            writer.write_batch(batch)
        if writer is None:
            return Part(None, None)
        writer.close()
        out.close()
        return Part(attempt, posixpath.join(path, name))

    def commit(self, messages):
        from pyarrow import fs

        system, path = _place(self.path)
        system.create_dir(path, recursive=True)
        if self.overwrite:
            for x in system.get_file_info(fs.FileSelector(path)):
                if x.path.endswith(ENDINGS) and not x.base_name.startswith("_"):
                    system.delete_file(x.path)
        for m in messages:
            if m is not None and m.attempt:
                system.move(m.attempt, m.final)

    def abort(self, messages):
        system, _ = _place(self.path)
        for m in messages:
            if m is not None and m.attempt:
                system.delete_file(m.attempt)


class ArrowFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "arrow_ipc"

    def reader(self, schema):
        return ArrowReader(self.options["path"], schema)

    def writer(self, schema, overwrite: bool):
        return ArrowWriter(self.options["path"], self.options.get("layout", "file") == "stream", overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(ArrowFiles)
