"""Keep streaming queries running: restart those that fail, from their checkpoint, a limited number of times."""

from __future__ import annotations

import queue
import time
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

Start = Callable[[], StreamingQuery]


class _Events(StreamingQueryListener):
    """Passes what happens on to the thread that supervises; a listener itself must not start queries."""

    def __init__(self, happened: queue.Queue):
        self._happened = happened

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        if event.progress.numInputRows:
            self._happened.put(("progress", str(event.progress.runId), None))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._happened.put(("end", str(event.runId), event.exception))


@dataclass
class Supervisor:
    """Runs queries by name. ``start`` has to give a query the same checkpoint each time.

    A query that fails is started again, ``attempts`` times in a row, with pauses that double; a batch that
    succeeds gives it all attempts back. If they are used up, the other queries are stopped and the error is
    raised. Queries that stop by themselves are done.
    """

    spark: SparkSession
    start: Mapping[str, Start]
    attempts: int = 3
    pause: float = 1.0
    restarts: dict[str, int] = field(default_factory=dict)

    def run(self) -> None:
        happened: queue.Queue = queue.Queue()
        listener = _Events(happened)
        self.spark.streams.addListener(listener)
        running: dict[str, tuple[str, StreamingQuery]] = {}
        failed = dict.fromkeys(self.start, 0)
        try:
            for name in self.start:
                self._launch(name, running)
            while running:
                kind, run_id, error = happened.get()
                name = next((n for n, (known, _) in running.items() if known == run_id), None)
                if name is None:
                    continue
                if kind == "progress":
                    failed[name] = 0
                elif error is None:
                    del running[name]
                else:
                    failed[name] += 1
                    _, query = running.pop(name)
                    if failed[name] > self.attempts:
                        raise query.exception() or RuntimeError(f"{name}: {error}")
                    time.sleep(self.pause * 2 ** (failed[name] - 1))
                    self.restarts[name] = self.restarts.get(name, 0) + 1
                    self._launch(name, running)
        finally:
            self.spark.streams.removeListener(listener)
            for _, query in running.values():
                query.stop()

    def _launch(self, name: str, running: dict[str, tuple[str, StreamingQuery]]) -> None:
        query = self.start[name]()
        running[name] = (str(query.runId), query)
