"""The committed sink: exact after failed tasks and replayed batches."""

import os
import shutil

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from guardlake.streaming import committed

SCHEMA = StructType([StructField("id", LongType()), StructField("note", StringType())])


def batches(*ids):
    return iter([pa.RecordBatch.from_pydict({"id": pa.array(ids, pa.int64()), "note": pa.array([str(i) for i in ids])})])


def rows(spark, path):
    return sorted(r.id for r in committed.read_committed(spark, path, SCHEMA).collect())


def test_only_committed_files_are_read(spark, tmp_path):
    path = str(tmp_path)
    writer = committed.CommittedWriter(path, SCHEMA)
    assert rows(spark, path) == []
    empty = writer.write(batches())
    writer.commit([empty, None], 0)
    assert rows(spark, path) == [] and committed.read_committed(spark, path).schema == SCHEMA
    first, lost = writer.write(batches(1, 2)), writer.write(batches(3))
    assert (first.rows, len(first.names)) == (2, 1)
    writer.abort([first, None], 1)
    assert rows(spark, path) == [] and os.listdir(f"{path}/data") == lost.names
    writer.commit([writer.write(batches(1, 2)), writer.write(batches(3))], 1)
    assert rows(spark, path) == [1, 2, 3]
    writer.commit([writer.write(batches(1, 2, 3))], 1)
    writer.commit([writer.write(batches(4))], 2)
    assert rows(spark, path) == [1, 2, 3, 4]
    assert [(k, v["rows"]) for k, v in committed.commits(path).items()] == [(0, 0), (1, 3), (2, 1)]


@pytest.mark.parametrize("lost", [0, 2])
def test_replayed_batch_is_written_once(spark, tmp_path, lost):
    for i in range(3):
        spark.range(i * 10, i * 10 + 10).withColumn("note", F.lit("x")).coalesce(2).write.mode("append").parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 2).parquet(str(tmp_path / "in"))

    def run():
        query = committed.write_committed(source.where("id % 5 <> 0"), str(tmp_path / "out"), str(tmp_path / "c"))
        query.awaitTermination(120)
        assert query.exception() is None

    run()
    want = [i for i in range(30) if i % 5]
    assert rows(spark, str(tmp_path / "out")) == want
    # As if the driver had been lost after the sink's commit and before the query's own, from that batch on.
    done = sorted(int(n) for n in os.listdir(tmp_path / "c" / "commits") if n.isdigit())
    for batch in done[lost:]:
        for name in (str(batch), f".{batch}.crc"):
            target = tmp_path / "c" / "commits" / name
            if target.exists():
                shutil.move(target, tmp_path / f"taken-{name}")
    run()
    assert rows(spark, str(tmp_path / "out")) == want
