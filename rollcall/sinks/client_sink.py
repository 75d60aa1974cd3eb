"""A sink that hands Arrow batches to a client and makes a batch visible only when all of its tasks are done."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Protocol

import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceStreamArrowWriter, WriterCommitMessage


class Client(Protocol):
    """What the sink asks of a client. Tasks stage, the driver publishes or discards."""

    def stage(self, rows: pa.RecordBatch) -> str:
        """Store rows where no reader sees them; the name they can be published by."""

    def publish(self, batch: str, names: list[str]) -> None:
        """Make the named rows visible as ``batch``; nothing if that batch is visible already."""

    def discard(self, names: list[str]) -> None:
        """Forget staged rows. Those of a task that was lost are never named."""

    def close(self) -> None: ...


def client_sink(name: str, open_client: Callable[[dict[str, str]], Client], rows: int = 10_000) -> type[DataSource]:
    """A data source to register with ``spark.dataSource.register`` and to write to by ``name``, in batch and as a stream.

    ``open_client`` gets the options of the write, once in each task and once for each commit; it travels with the plan. A call
    of ``stage`` gets at most ``rows`` rows. A stream that runs a batch again after a failure publishes it under the same number,
    which the client takes once; a batch write names itself by the option ``batch``. Attempts of a task that failed stage rows which
    no commit names. An empty batch is published with no names.
    """

    @dataclass
    class Staged(WriterCommitMessage):
        names: list[str]

    class Writer:
        def __init__(self, options: dict[str, str]) -> None:
            self.options = options

        def stage(self, batches: Iterator[pa.RecordBatch]) -> Staged:
            client, names = open_client(self.options), []
            try:
                for batch in batches:
                    names += [client.stage(batch.slice(at, rows)) for at in range(0, batch.num_rows, rows)]
            finally:
                client.close()
            return Staged(names)

        def end(self, messages: list[Staged | None], batch: str | None) -> None:
            names = [n for m in messages if m is not None for n in m.names]
            client = open_client(self.options)
            try:
                client.discard(names) if batch is None else client.publish(batch, names)
            finally:
                client.close()

    class BatchWriter(DataSourceArrowWriter):
        def __init__(self, options: dict[str, str]) -> None:
            self.inner = Writer(options)

        def write(self, iterator):
            return self.inner.stage(iterator)

        def commit(self, messages):
            self.inner.end(messages, self.inner.options["batch"])

        def abort(self, messages):
            self.inner.end(messages, None)

    class StreamWriter(DataSourceStreamArrowWriter):
        def __init__(self, options: dict[str, str]) -> None:
            self.inner = Writer(options)

        def write(self, iterator):
            return self.inner.stage(iterator)

        def commit(self, messages, batchId):
            self.inner.end(messages, str(batchId))

        def abort(self, messages, batchId):
            self.inner.end(messages, None)

    class Sink(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def writer(self, schema, overwrite):
            if overwrite:
                raise ValueError("batches are added to the sink: write with mode append")
            if "batch" not in self.options:
                raise ValueError("name the write by the option batch, so that a repeated one counts once")
            return BatchWriter(dict(self.options))

        def streamWriter(self, schema, overwrite):
            return StreamWriter(dict(self.options))

    return Sink
