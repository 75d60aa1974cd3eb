"""Writing rows through a client that takes them one request at a time."""

from __future__ import annotations

from collections.abc import Callable


class ClientWriter:
    """For ``writeStream.foreach``: one client per task, requests of ``size`` rows.

    ``put`` should be an upsert: after a failure a task sends its rows again.
    """

    def __init__(self, open_client: Callable[[], object], put: Callable[[object, list[dict]], None], size: int = 500):
        self._open_client = open_client
        self._put = put
        self._size = size

    def open(self, partition_id: int, epoch_id: int) -> bool:
        self._client = self._open_client()
        self._waiting: list[dict] = []
        return True

    def process(self, row) -> None:
        self._waiting.append(row.asDict(recursive=True))
        if len(self._waiting) >= self._size:
            self._flush()

    def close(self, error: Exception | None) -> None:
        if error is None:
            self._flush()
        close = getattr(self._client, "close", None)
        if close:
            close()

    def _flush(self) -> None:
        if self._waiting:
            self._put(self._client, self._waiting)
            self._waiting = []
