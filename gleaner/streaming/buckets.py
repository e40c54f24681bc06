"""Tables that streams keep in hash buckets: a batch reads and rewrites only the buckets that its keys fall into.

A version of a bucket is a folder that never changes; a manifest for each batch says which version of every bucket is current. Batch n
starts from the manifest of batch n - 1 and writes version n of the buckets it touches, so a batch that is run again replaces its
own work and nothing else. Readers take one manifest and see one state. Versions that no kept manifest names can be removed
(`vacuum`). The number of buckets is chosen for the size of the table: about `table bytes / 64 MB`; `rebucketed` changes it. Single writer."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

Merge = Callable[[DataFrame, DataFrame], DataFrame]
MANIFEST = "bucket int, version long"


class BucketTable:
    """A table under `base`, dealt by a hash of `keys` into `buckets`."""

    def __init__(self, spark: SparkSession, base: str, schema: str | StructType, keys: list[str], buckets: int = 64) -> None:
        self.spark, self.base, self.keys, self.buckets = spark, base.rstrip("/"), keys, buckets
        self.schema = spark.createDataFrame([], schema).schema

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def versions(self, number: int) -> dict[int, int]:
        """Version by bucket after batch `number`: at most one row a bucket."""
        if number < 0:
            return {}
        return {r["bucket"]: r["version"] for r in self.spark.read.schema(MANIFEST).parquet(f"{self.base}/manifest/batch={number}").collect()}

    def rows(self, versions: dict[int, int]) -> DataFrame:
        """The rows of some buckets at some versions."""
        paths = [f"{self.base}/version={v}/bucket={b}" for b, v in sorted(versions.items())]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def read(self, number: int) -> DataFrame:
        """The table as batch `number` left it."""
        return self.rows(self.versions(number))

    def put(self, batch: DataFrame, number: int, merge: Merge) -> None:
        """Batch `number`: merge(stored rows of the touched buckets, batch) becomes their next version."""
        batch = batch.persist()
        try:
            before = self.versions(number - 1)
            touched = {r[0] for r in batch.select(self.bucket()).distinct().collect()}  # at most the number of buckets
            merged = merge(self.rows({b: v for b, v in before.items() if b in touched}), batch).select(*self.schema.names).withColumn("bucket", self.bucket())
            merged.repartition(max(1, len(touched)), "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.base}/version={number}")
            after = before | dict.fromkeys(touched, number)
            self.spark.createDataFrame(sorted(after.items()), MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{self.base}/manifest/batch={number}")
        finally:
            batch.unpersist()

    def vacuum(self, kept: list[int]) -> list[str]:
        """Remove the versions of buckets that no kept manifest names; gives their folders."""
        named = {(b, v) for n in kept for b, v in self.versions(n).items()}
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.base)
        files, gone = path.getFileSystem(self.spark._jsc.hadoopConfiguration()), []
        for version in files.listStatus(path):
            name = version.getPath().getName()
            for folder in files.listStatus(version.getPath()) if name.startswith("version=") else []:
                b = folder.getPath().getName()
                if b.startswith("bucket=") and (int(b[7:]), int(name[8:])) not in named:
                    files.delete(folder.getPath(), True)
                    gone.append(f"{name}/{b}")
        return sorted(gone)

    def rebucketed(self, number: int, base: str, buckets: int) -> BucketTable:
        """The table as batch `number` left it, in another number of buckets under another folder, as its batch `number`."""
        other = BucketTable(self.spark, base, self.schema, self.keys, buckets)
        rows = self.read(number).withColumn("bucket", other.bucket())
        rows.repartition(buckets, "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{other.base}/version={number}")
        held = rows.select("bucket").distinct().withColumn("version", F.lit(number).cast("long"))  # one row a bucket
        held.coalesce(1).write.mode("overwrite").parquet(f"{other.base}/manifest/batch={number}")
        return other


def keep_buckets(stream: DataFrame, table: BucketTable, merge: Merge) -> DataFrame:
    """Run a stream to the end of what has arrived, with its checkpoint beside the table; gives the table. A later call goes on."""
    last = [-1]

    def put(batch: DataFrame, number: int) -> None:
        table.put(batch, number, merge)
        last[0] = number

    job = stream.writeStream.option("checkpointLocation", f"{table.base}/state").trigger(availableNow=True).foreachBatch(put).start()
    job.awaitTermination()
    if job.exception():
        raise job.exception()
    return table.read(last[0] if last[0] >= 0 else last_batch(table))


def last_batch(table: BucketTable) -> int:
    """The number of the newest batch with a manifest; -1 before the first."""
    path = table.spark._jvm.org.apache.hadoop.fs.Path(f"{table.base}/manifest")
    files = path.getFileSystem(table.spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return -1
    return max((int(s.getPath().getName()[6:]) for s in files.listStatus(path) if s.getPath().getName().startswith("batch=")), default=-1)
