"""Feeds that keep arriving: a file stream lands raw rows and brings the kept tables up to date.

The kept tables are the state of the stream: a micro-batch is a load of its own in them,
numbered as the batch is, so that a batch that runs again replaces what it left. Feeds known
already are left out; a feed that comes late is numbered after those that were there, as if it
had been read last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from busgrid.layouts import FILES, VERSION_TABLE
from busgrid.plans.kept import KeptTables
from busgrid.session import work_folder
from busgrid.sources import feeds

FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def land_new_zips(
    spark: SparkSession, root: str, landing: str, checkpoint: str
) -> StreamingQuery:
    """Decodes the zips that are new since the last run and adds their rows to ``landing``.

    Each micro-batch writes a folder of its own and replaces it when it is run again,
    so a lost executor or a restart leaves no row twice. The query stops when all
    files that were there at its start are landed.
    """

    def land(files: DataFrame, batch: int) -> None:
        rows = feeds.parsed(feeds.records_of_zips(files))
        below = rows.withColumn("feed_id", feeds.below(rows["feed_id"], root))
        feeds.land(below, f"{landing.rstrip('/')}/batch={batch}")

    return (
        spark.readStream.format("binaryFile")
        .schema(FILE_SCHEMA)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", feeds.ZIP_FILES)
        .load(root)
        .select("path")  # so that no content is read here
        .writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def rows_of_batch(spark: SparkSession, files: DataFrame, root: str) -> DataFrame:
    """Raw rows of the zips of a batch, and of the folders whose version file is in it."""
    is_zip = F.lower("path").endswith(".zip")
    zipped = feeds.parsed(feeds.records_of_zips(files.where(is_zip).select("path")))
    # A batch has a bounded number of files; their folders are listed for the reader.
    marked = files.where(~is_zip).select(F.regexp_replace("path", "/[^/]*$", "").alias("folder"))
    folders = [r.folder for r in marked.distinct().collect()]
    rows = zipped
    if folders:
        rows = rows.unionByName(feeds.parsed(feeds.records_of_files(spark, folders)))
    return rows.withColumn("feed_id", feeds.below(F.col("feed_id"), root))


def update_tables(
    spark: SparkSession,
    root: str,
    tables: KeptTables,
    checkpoint: str,
    most_files: int = 10_000,
) -> StreamingQuery:
    """Adds the feeds below ``root`` that are new since the last run to the kept tables.

    A zip is a feed once it is there; a folder is one once its version file is there, which
    must be written last. The query stops when all files that were there at its start are
    taken, at most ``most_files`` at a time.
    """
    version_file = feeds.any_case(FILES[VERSION_TABLE])

    def add(files: DataFrame, batch: int) -> None:
        add_batch(files, batch, root, tables)

    return (
        spark.readStream.format("binaryFile")
        .schema(FILE_SCHEMA)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "{" + f"{feeds.ZIP_FILES},{version_file}" + "}")
        .option("maxFilesPerTrigger", most_files)
        .load(root)
        .select("path")
        .writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def add_batch(files: DataFrame, batch: int, root: str, tables: KeptTables) -> None:
    """Adds one micro-batch of paths as the load of that number."""
    spark = files.sparkSession
    landed = feeds.land(rows_of_batch(spark, files, root), work_folder(spark, "arrived"))
    tables.add_rows(landed, batch)
