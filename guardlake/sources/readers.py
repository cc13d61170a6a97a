"""Table readers."""


def read_table(spark, path):
    """Parquet table as its files are split; ``spark.sql.files.maxPartitionBytes`` sets the size of a task's share."""
    return spark.read.parquet(path)
