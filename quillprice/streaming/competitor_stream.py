"""Competitor feed as a stream: X9 run once per micro-batch (foreachBatch).

New feed files landing in a folder are picked up by a file stream; every
micro-batch applies the same high-water gate and upsert as the batch
pipeline to the current sheet version and publishes the next version.
Rows not newer than the sheet's mark are dropped, exactly as the batch
procedure drops them (no late-data tolerance in the reference).

The sheet is a folder of versions ``v=<batch id>``; a version is complete
once its ``_SUCCESS`` marker exists. A replayed batch rewrites its own
version from the previous one, so replays are idempotent and the stream's
checkpoint (offsets in the shared checkpoint folder) gives exactly-once
publication. Batch ids belong to one checkpoint: the sheet folder names the
checkpoint that writes it, and a stream with another (or an emptied) one is
refused, as its batch ids would overwrite published versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from quillprice.plans.competitor import competitor_incremental_upsert


class SheetVersions:
    """Versioned parquet folder holding the competitor sheet."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _fs(self):
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.root)
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), jvm

    def versions(self) -> list[int]:
        fs, jvm = self._fs()
        root = jvm.org.apache.hadoop.fs.Path(self.root)
        if not fs.exists(root):
            return []
        out = []
        for st in fs.listStatus(root):
            name = st.getPath().getName()
            if name.startswith("v=") and fs.exists(
                    jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
                out.append(int(name[2:]))
        return sorted(out)

    def path(self, version: int) -> str:
        return f"{self.root}/v={version}"

    def read(self, before: int | None = None) -> DataFrame:
        vs = [v for v in self.versions() if before is None or v < before]
        return self.spark.read.parquet(self.path(vs[-1]))

    def write(self, df: DataFrame, version: int) -> None:
        df.write.mode("overwrite").parquet(self.path(version))


    def exists(self, path: str) -> bool:
        fs, jvm = self._fs()
        return fs.exists(jvm.org.apache.hadoop.fs.Path(path))

    def claim(self, checkpoint: str) -> None:
        """Bind the folder to one checkpoint; raise if it belongs to another."""
        owner = f"{self.root}/owner"
        if not self.exists(owner):
            if any(v >= 0 for v in self.versions()):
                raise ValueError(f"{self.root} has versions of an unknown checkpoint")
            self.spark.createDataFrame([(checkpoint,)], "value string").coalesce(1).write.text(owner)
            return
        written = self.spark.read.text(owner).first()["value"]
        if written != checkpoint:
            raise ValueError(f"{self.root} belongs to checkpoint {written}, not {checkpoint}")
        if any(v >= 0 for v in self.versions()) and not self.exists(f"{checkpoint}/offsets"):
            raise ValueError(f"{self.root} has versions, but checkpoint {checkpoint} is empty")


def start_competitor_stream(spark: SparkSession, feed_dir: str, feed_schema: T.StructType,
                            line_map: DataFrame, sheet_root: str, checkpoint: str,
                            initial_sheet: DataFrame | None = None, available_now: bool = True,
                            max_files_per_trigger: int | None = None):
    """Start the stream; returns the StreamingQuery.

    ``initial_sheet`` seeds version -1 when the sheet folder is empty.
    """
    checkpoint = checkpoint.rstrip("/")
    store = SheetVersions(spark, sheet_root)
    store.claim(checkpoint)
    if initial_sheet is not None and not store.versions():
        store.write(initial_sheet, -1)

    def upsert(batch: DataFrame, batch_id: int) -> None:
        current = store.read(before=batch_id)
        store.write(competitor_incremental_upsert(batch, line_map, current), batch_id)

    reader = spark.readStream.schema(feed_schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    writer = (reader.parquet(feed_dir).writeStream.foreachBatch(upsert)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="10 seconds")
    return writer.start()
