"""Stored relations with an owner.

`SELECT ... INTO #t` keeps a relation that several arms read. A `Staging` stores such
relations in the shared folder the session names in `spark.checkpoint.dir` and deletes them
when it is closed:

    with Staging(spark) as staging:
        ev_report(src, params, staging=staging).write.parquet(out)

A frame that reads a stored relation must have run before the staging closes. Where the
caller gives none, frames are handed out before they run, so that only the end of the
application is surely after their last reader: `Staging.of_application` closes then.
"""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession

from hourglass.session import ensure_checkpoint_dir


class Staging:
    _of_application: dict[str, "Staging"] = {}

    def __init__(self, spark: SparkSession, name: str = "staging"):
        self.folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        # kept here, so that closing works after the session has ended as well
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.folder)
        self._files = self._path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self.closed = False

    @classmethod
    def of_application(cls, spark: SparkSession) -> "Staging":
        """The staging that lasts as long as the application."""
        app = spark.sparkContext.applicationId
        if app not in cls._of_application:
            cls._of_application[app] = cls(spark, f"staging-{app}")
            atexit.register(cls._of_application[app].close)
        return cls._of_application[app]

    def path(self, name: str) -> str:
        if self.closed:
            raise ValueError("the staging is closed; its relations are gone")
        return f"{self.folder}/{name}-{uuid.uuid4().hex}"

    def store(self, df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
        """`df`, written once and read back: columns and filters of its readers reach the files."""
        path = self.path(name)
        writer = df.write if partition_by is None else df.write.partitionBy(partition_by)
        writer.parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)

    def close(self) -> None:
        """Deletes everything stored here, also what an unfinished write has left."""
        if not self.closed:
            self.closed = True
            try:
                self._files.delete(self._path, True)
            except Exception as gone:  # at exit the JVM may have ended before us
                if not isinstance(gone, OSError) and "py4j" not in type(gone).__module__:
                    raise

    def __enter__(self) -> "Staging":
        return self

    def __exit__(self, *error) -> None:
        self.close()
