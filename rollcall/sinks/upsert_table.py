"""Tables kept current by keyed upserts, as plain Parquet folders.

Each batch is reduced to one row per key and appended under its batch id, so the
cost of an upsert follows the size of the batch, not of the table. Readers merge
what is there; ``compact`` folds it into one base folder from time to time. A
batch that is written again replaces its own folder, so a replay after a failure
changes nothing. Folders count from the moment their ``_SUCCESS`` file exists.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..operators.latest import latest_rows

_BATCH = "batch_id"


class _BatchFolders:
    """``kind=delta|base/batch_id=N`` below one path."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def write(self, rows: DataFrame, kind: str, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/kind={kind}/{_BATCH}={batch_id}")

    def listed(self) -> tuple[int | None, list[int]]:
        """(newest base, batches after it), from one listing, so that a fold in between can't tear a read."""
        finished = self._finished()
        base = max(finished["base"], default=None)
        return base, sorted(b for b in finished["delta"] if base is None or b > base)

    def load(self, schema: StructType, before: int | None = None) -> tuple[DataFrame | None, bool]:
        """Rows of the newest base and of the batches after it, with their batch id; whether they are one per key.

        With ``before`` only batches with a smaller number count.
        """
        base, deltas = self.listed()
        deltas = [b for b in deltas if before is None or b < before]
        kinds = [("delta", b) for b in deltas] + ([("base", base)] if base is not None else [])
        if not kinds:
            return None, True
        full = StructType([*schema.fields, StructField("kind", StringType()), StructField(_BATCH, LongType())])
        folders = [f"{self.path}/kind={kind}/{_BATCH}={b}" for kind, b in kinds]
        loaded = self.spark.read.schema(full).option("basePath", self.path).parquet(*folders).drop("kind")
        return loaded, len(kinds) == 1

    def drop_folded(self) -> int:
        """Delete what was needless already before the newest base; gives the number of folders.

        A reader that listed the folders before the newest base still finds all of them.
        """
        finished = self._finished()
        bases = sorted(finished["base"])
        if len(bases) < 2:
            return 0
        old = [(kind, b) for kind in ("delta", "base") for b in finished[kind] if b < bases[-2]]
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        for kind, b in old:
            folder = hadoop.Path(f"{self.path}/kind={kind}/{_BATCH}={b}")
            folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)
        return len(old)

    def _finished(self) -> dict[str, list[int]]:
        # Hadoop's own file system client, so that any cluster storage will do.
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        pattern = hadoop.Path(f"{self.path}/kind=*/{_BATCH}=*/_SUCCESS")
        found = pattern.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(pattern) or []
        batches: dict[str, list[int]] = {"delta": [], "base": []}
        for folder in (f.getPath().getParent() for f in found):
            batches[folder.getParent().getName().split("=")[1]].append(int(folder.getName().split("=")[1]))
        return batches


class _Folded:
    """Folding the batches of a table, for both kinds of tables."""

    _folders: _BatchFolders

    def compact(self, every: int = 1, before: int | None = None) -> bool:
        """Fold all batches so far into a new base, if at least ``every`` have come since the last one.

        With ``before`` only batches with a smaller number, as long as a later one may be run again.
        """
        _, since = self._folders.listed()
        since = [b for b in since if before is None or b < before]
        if not since or len(since) < every:
            return False
        # A batch that comes in between is read twice, once in the base and once by itself: merging is idempotent.
        self._folders.write(self._current(before), "base", since[-1])
        return True

    def keep_small(self, every: int, before: int | None = None) -> None:
        """Fold now and then, and delete what no reader can need any more."""
        if self.compact(every, before):
            self._folders.drop_folded()

    def drop_folded(self) -> int:
        return self._folders.drop_folded()

    def _refuse_old(self, batch_id: int) -> None:
        base, _ = self._folders.listed()
        if base is not None and batch_id < base:
            raise ValueError(
                f"batch {batch_id} is older than the compacted base {base} of {self._folders.path}: "
                "a stream with a new checkpoint needs a new table")


class UpsertTable(_Folded):
    """An upsert replaces the whole row of its key. Within a batch ``order`` decides, then the later batch."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, keys: Sequence[str]):
        self.spark = spark
        self.schema = schema
        self.keys = tuple(keys)
        self._folders = _BatchFolders(spark, path)

    def upsert(self, rows: DataFrame, batch_id: int, order: Sequence[str]) -> None:
        self._refuse_old(batch_id)
        names = self.schema.fieldNames()
        extra = [c for c in order if c not in names]
        reduced = latest_rows(rows.select(*names, *extra), self.keys, list(order)).select(*names)
        self._folders.write(reduced, "delta", batch_id)

    def read(self, before: int | None = None) -> DataFrame:
        """The current rows, one per key; with ``before`` as they were before that batch."""
        loaded, single = self._folders.load(self.schema, before)
        if loaded is None:
            return self.spark.createDataFrame([], self.schema)
        return loaded.drop(_BATCH) if single else latest_rows(loaded, self.keys, [_BATCH]).drop(_BATCH)

    _current = read


class CellTable(_Folded):
    """An upsert replaces single values: a NULL leaves the stored one alone, and so does an older one.

    Each value is stored with the time it is from and a number of the record it is from. The
    later time wins, and among records of one time the same record in all columns. So
    it does not matter in which batch or how often a value arrives, and a row
    that a watermark held back does not undo newer ones.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType, keys: Sequence[str]):
        self.spark = spark
        self.schema = schema
        self.keys = tuple(keys)
        self._values = [f for f in schema if f.name not in self.keys]
        self._stored = StructType([
            *[schema[k] for k in self.keys],
            *[StructField(f.name, StructType([
                StructField("at", LongType()), StructField("tie", LongType()), StructField("value", f.dataType)]))
              for f in self._values],
        ])
        self._folders = _BatchFolders(spark, path)

    def upsert(self, rows: DataFrame, batch_id: int, at: Mapping[str, Sequence[str]] | Sequence[str]) -> None:
        """``at`` names the bigint columns with the time of a value and the number of its record, for all or for each."""
        self._refuse_old(batch_id)
        times = {f.name: at[f.name] if isinstance(at, Mapping) else at for f in self._values}
        cells = rows.selectExpr(
            *[f"`{k}`" for k in self.keys],
            *[f"IF(`{c}` IS NULL, NULL, named_struct('at', `{t}`, 'tie', `{tie}`, 'value', `{c}`)) AS `{c}`"
              for c, (t, tie) in times.items()],
        )
        self._folders.write(self._merge(cells), "delta", batch_id)

    def read(self) -> DataFrame:
        """The current rows, one per key."""
        cells = self._current()
        if cells is None:
            return self.spark.createDataFrame([], self.schema)
        return cells.selectExpr(*[
            f"`{f.name}`" if f.name in self.keys else f"`{f.name}`.value AS `{f.name}`" for f in self.schema])

    def _current(self, before: int | None = None) -> DataFrame | None:
        loaded, single = self._folders.load(self._stored, before)
        if loaded is None:
            return None
        cells = loaded.drop(_BATCH)
        return cells if single else self._merge(cells)

    def _merge(self, cells: DataFrame) -> DataFrame:
        return cells.groupBy(*self.keys).agg(*[F.expr(f"max(`{f.name}`) AS `{f.name}`") for f in self._values])
