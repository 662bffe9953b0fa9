"""An exactly-once sink that is fed by ``foreachBatch``.

Spark hands a micro-batch to ``foreachBatch`` at least once: after a failure
between the sink's write and Spark's commit it comes again, with the same
number and rows.  A :class:`BatchTable` keys what it writes by that number:

1. the rows are written to a staging folder of their own, which no reader
   sees;
2. one rename to ``batch=<number>`` commits them; it fails if the folder
   exists, and is atomic on HDFS and on local file systems (an object store
   needs a committer that has such a rename);
3. a micro-batch whose folder exists is already committed: its replay is run
   (a stateful query commits the state of a micro-batch only when its rows are
   read) but writes nothing.

Numbers start again in every checkpoint, so a table belongs to the query that
wrote it first; another one is refused.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class BatchTable:
    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self._jvm = spark._jvm
        conf = spark._jsc.hadoopConfiguration()
        folder = self._path(self.path)
        self._fs = folder.getFileSystem(conf)
        self._files = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), conf)
        self._fs.mkdirs(folder)

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def _own(self, query: str | None) -> None:
        names = [f.getPath().getName() for f in self._fs.listStatus(self._path(self.path))]
        owners = [n.removeprefix("_owner-") for n in names if n.startswith("_owner-")]
        if owners and query and owners != [query]:
            raise ValueError(f"{self.path} belongs to the query {owners[0]}")
        if not owners and query:
            self._fs.mkdirs(self._path(f"{self.path}/_owner-{query}"))

    def committed(self, batch: int) -> bool:
        return self._fs.exists(self._path(f"{self.path}/batch={batch}"))

    def write(self, rows: DataFrame, batch: int, query: str | None = None) -> bool:
        """Write and commit a micro-batch; False if it was committed before."""
        self._own(query)
        if self.committed(batch):
            rows.write.format("noop").mode("overwrite").save()
            return False
        staging = f"{self.path}/_staging/{batch}-{uuid.uuid4().hex}"
        rows.write.parquet(staging)
        self.commit(staging, batch)
        return True

    def commit(self, staging: str, batch: int) -> None:
        rename = self._jvm.org.apache.hadoop.fs.Options.Rename
        none = self.spark.sparkContext._gateway.new_array(rename, 0)
        self._files.rename(self._path(staging), self._path(f"{self.path}/batch={batch}"), none)

    def each_batch(self, rows: DataFrame, batch: int) -> None:
        """The function for ``foreachBatch``."""
        query = rows.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        self.write(rows, batch, query)

    def read(self) -> DataFrame:
        """The committed rows, and their micro-batch as ``batch long``."""
        return self.spark.read.schema(f"{self.schema}, batch long").parquet(self.path)

    def latest(self, by: list[str], order: list[str]) -> DataFrame:
        """The newest row per key: the table that the stream of its updates
        stands for."""
        row = F.struct(*[c for c in self.read().columns if c not in by and c != "batch"])
        newest = self.read().groupBy(*by).agg(F.max_by(row, F.struct("batch", *order)).alias("_row"))
        return newest.select(*by, "_row.*")

    def drop_staging(self) -> None:
        """Remove what failed attempts have left; not while a query writes."""
        self._fs.delete(self._path(f"{self.path}/_staging"), True)
