"""A client for ``client_sink`` that keeps rows in a folder, so that what it was given can be read back."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def folder_client():
    """The class of the client. It is made here so that it travels with the plan, and workers need no copy of this module."""
    import pyarrow as pa
    import pyarrow.fs as pafs
    import pyarrow.parquet as pq

    class FolderClient:
        """Staged rows are files. A batch is one small file with the names that belong to it."""

        def __init__(self, options: dict[str, str]) -> None:
            self.files, self.root = pafs.FileSystem.from_uri(options["root"])
            for folder in ("staged", "batches", "made"):
                self.files.create_dir(f"{self.root}/{folder}", recursive=True)

        def stage(self, rows: pa.RecordBatch) -> str:
            name = f"{uuid.uuid4().hex}.parquet"
            pq.write_table(pa.Table.from_batches([rows]), f"{self.root}/staged/{name}", filesystem=self.files)
            return name

        def publish(self, batch: str, names: list[str]) -> None:
            made, published = f"{self.root}/made/{uuid.uuid4().hex}", f"{self.root}/batches/{batch}.json"
            if self.files.get_file_info(published).type != pafs.FileType.NotFound:
                self.discard(names)
                return
            # Moved when it is whole, so that a reader finds all of a batch or nothing.
            with self.files.open_output_stream(made) as out:
                out.write(json.dumps({"names": names}).encode())
            self.files.move(made, published)

        def discard(self, names: list[str]) -> None:
            for name in names:
                self.files.delete_file(f"{self.root}/staged/{name}")

        def close(self) -> None:
            """Nothing is held open."""

    return FolderClient


def read_folder(spark: SparkSession, root: str, schema: StructType) -> DataFrame:
    """The rows of all published batches."""
    names = spark.read.schema("names array<string>").json(f"{root}/batches").select(F.explode("names").alias("_name"))
    staged = spark.read.schema(schema).parquet(f"{root}/staged").select("*", F.col("_metadata.file_name").alias("_name"))
    return staged.join(names, "_name", "left_semi").drop("_name")
