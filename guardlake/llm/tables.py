"""Written intermediate tables."""

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(frame, path):
    """Write a frame to a new folder that all executors share, and read it back.

    The table cuts the lineage, so the shuffle files behind it go at once; by
    itself Spark keeps them until the driver collects its garbage.
    """
    spark = frame.sparkSession
    before = spark.conf.get(CLEANUP, None)
    if before is not None:
        spark.conf.set(CLEANUP, "true")
    try:
        frame.write.parquet(path)
    finally:
        if before is not None:
            spark.conf.set(CLEANUP, before)
    return spark.read.parquet(path)
