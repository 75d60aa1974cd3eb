"""Intermediate tables of one operator call, which go when nothing reads them any more."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rollcall.session import fresh_dir


#: Folders of each application that results may still read.
_left: dict[str, list[str]] = {}


def left_behind(spark: SparkSession, path: str) -> None:
    """Remember a folder that a result reads."""
    _left.setdefault(spark.sparkContext.applicationId, []).append(path)


def folders(spark: SparkSession) -> list[str]:
    """All folders that results of this application were left with."""
    return list(_left.get(spark.sparkContext.applicationId, []))


def release(spark: SparkSession, paths: list[str], *reading: DataFrame) -> None:
    """Delete folders that results were left with and that are not needed, but for those that ``reading`` reads."""
    read = [f for frame in reading for f in frame.inputFiles()]
    left = _left.get(spark.sparkContext.applicationId, [])
    for path in paths:
        name = path.rstrip("/").rsplit("/", 1)[-1]
        if path in left and not any(f"/{name}/" in f for f in read):
            left.remove(path)
            _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    # Hadoop's own file system client, so that any cluster storage will do.
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


class Scratch:
    """Tables below the shared folder. What is not kept goes when the block ends, also when it fails.

    A table that a returned, not yet written DataFrame reads has to be kept; ``release`` deletes it later.
    """

    def __init__(self, spark: SparkSession) -> None:
        self._spark = spark
        self._paths: dict[int, tuple[DataFrame, str]] = {}

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *failure: object) -> None:
        self.drop(*[frame for frame, _ in self._paths.values()])

    def store(self, df: DataFrame, label: str, compression: str = "zstd", by: str | None = None) -> DataFrame:
        """``df`` written and read again, in folders by the values of the column ``by`` if one is named."""
        path = fresh_dir(self._spark, label)
        writer = df.write.option("compression", compression)
        (writer.partitionBy(by) if by else writer).parquet(path)
        stored = self._spark.read.schema(df.schema).parquet(path)
        self._paths[id(stored)] = stored, path
        return stored

    def drop(self, *stored: DataFrame) -> None:
        """Delete tables that are not needed any more."""
        for frame in stored:
            _, path = self._paths.pop(id(frame), (None, None))
            if path:
                _delete(self._spark, path)

    def keep(self, *stored: DataFrame) -> None:
        """Leave tables where they are, for a result that reads them."""
        for frame in stored:
            _, path = self._paths.pop(id(frame), (None, None))
            if path:
                left_behind(self._spark, path)
