"""A streaming sink with a commit protocol, for review items, incidents and score rows.

Tasks write their rows to files of their own and report the names; the driver
commits a batch by one small file that lists them.  A reader sees listed files
only, so rows of failed tasks and of replaced batches are never read: a batch
that is replayed puts a new list in the place of the old one.
"""

import json
import posixpath
import uuid
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from guardlake.streaming.live import start_stateful

FORMAT = "guardlake_committed"
#: Rows of a Parquet row group.
GROUP_ROWS = 1 << 16


@dataclass
class Written(WriterCommitMessage):
    """Files a task wrote, and their rows."""

    names: list = field(default_factory=list)
    rows: int = 0


def _store(path):
    return fs.FileSystem.from_uri(path)


def _list_name(batch_id):
    return f"{batch_id:012d}.json"


class CommittedWriter(DataSourceStreamArrowWriter):
    def __init__(self, path, schema):
        self.path, self.schema = path, schema

    def write(self, iterator):
        """Write a task's rows to one file; a task without rows writes none."""
        store, place = _store(self.path)
        folder = posixpath.join(place, "data")
        name, writer, rows = f"{uuid.uuid4().hex}.parquet", None, 0
        try:
            for batch in iterator:
                if not batch.num_rows:
                    continue
                if writer is None:
                    store.create_dir(folder, recursive=True)
                    writer = pq.ParquetWriter(posixpath.join(folder, name), batch.schema, filesystem=store)
                writer.write_table(pa.Table.from_batches([batch]), row_group_size=GROUP_ROWS)
                rows += batch.num_rows
        finally:
            if writer is not None:
                writer.close()
        return Written([name] if rows else [], rows)

    def commit(self, messages, batchId):
        """List the files of a batch; a second commit of the batch takes the place of the first."""
        store, place = _store(self.path)
        folder = posixpath.join(place, "commits")
        store.create_dir(folder, recursive=True)
        done = [m for m in messages if m is not None]
        listed = {"files": sorted(n for m in done for n in m.names), "rows": sum(m.rows for m in done), "schema": self.schema.json()}
        draft = posixpath.join(folder, f".{uuid.uuid4().hex}")
        with store.open_output_stream(draft) as out:
            out.write(json.dumps(listed).encode())
        store.move(draft, posixpath.join(folder, _list_name(batchId)))

    def abort(self, messages, batchId):
        """Delete what the tasks that did succeed wrote."""
        store, place = _store(self.path)
        for name in (n for m in messages if m is not None for n in m.names):
            store.delete_file(posixpath.join(place, "data", name))


class CommittedTable(DataSource):
    """``writeStream.format("guardlake_committed").option("path", ...)``."""

    @classmethod
    def name(cls):
        return FORMAT

    def streamWriter(self, schema, overwrite):
        return CommittedWriter(self.options["path"], schema)


def write_committed(stream, path, checkpoint, **trigger):
    """Start writing an append-only stream to the committed table at ``path``, a folder all executors reach."""
    stream.sparkSession.dataSource.register(CommittedTable)
    writer = stream.writeStream.format(FORMAT).option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    return start_stateful(stream.sparkSession, writer.trigger(**(trigger or {"availableNow": True})).start)


def commits(path):
    """Lists of the committed batches by batch number."""
    store, place = _store(path)
    folder = posixpath.join(place, "commits")
    found = {}
    for info in store.get_file_info(fs.FileSelector(folder, allow_not_found=True)):
        if info.base_name.endswith(".json"):
            with store.open_input_stream(info.path) as f:
                found[int(info.base_name.removesuffix(".json"))] = json.loads(f.read())
    return dict(sorted(found.items()))


def read_committed(spark, path, schema=None):
    """Rows of all committed batches; without any, an empty table of ``schema``."""
    listed = list(commits(path).values())
    files = [f"{path}/data/{name}" for c in listed for name in c["files"]]
    if listed:
        schema = StructType.fromJson(json.loads(listed[-1]["schema"]))
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
