"""Running and stopping streaming queries (T-e, T-f) and stream sinks.

``drain`` replaces the reference's poll loop (sleep while data is available):
an ``availableNow`` query finishes by itself once everything present at start
is processed; a continuously triggered one is drained with
``processAllAvailable`` and then stopped.  Restarting a query on the same
checkpoint continues where it stopped: files already committed are not read
again (exactly-once into the parquet sink).
"""

from __future__ import annotations

from threading import Thread

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def drain(query: StreamingQuery, timeout_s: float | None = 600) -> StreamingQuery:
    """Block until the query has consumed everything available, then stop it.  A source that never idles ends the wait
    at ``timeout_s`` seconds (None: no bound): the query is stopped and TimeoutError raised.  What it has committed
    stays, and a restart on the same checkpoint goes on from there."""
    late = False
    if query.isActive:
        def consume():
            try:
                query.processAllAvailable()
            except Exception:        # the query failed or was stopped: query.exception() tells below
                pass

        waiting = Thread(target=consume, daemon=True)
        waiting.start()
        waiting.join(timeout_s)
        late = waiting.is_alive()
        query.stop()
    query.awaitTermination(timeout_s)
    exc = query.exception()
    if exc is not None:
        raise RuntimeError(f"streaming query failed: {exc}")
    if late:
        raise TimeoutError(f"the stream still had data after {timeout_s} s")
    return query


def to_parquet(df: DataFrame, path: str, checkpoint: str, *, trigger: dict | None = None,
               query_name: str | None = None) -> StreamingQuery:
    """Append a (stateless) stream into parquet files with a commit log."""
    w = (df.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint).option("path", path)
         .trigger(**(trigger or {"availableNow": True})))
    if query_name:
        w = w.queryName(query_name)
    return w.start()
