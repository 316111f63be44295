"""Live requests x latest-value snapshot.

``lookup_waves`` passes each wave (micro-batch) of requests through a function
that resolves the published snapshots anew, so a wave sees the newest publish
and the size check before a broadcast is made for the snapshot it joins.
``stream_lookup`` is a plain stream-static join against one snapshot, for
streams that end before the next publish.  The request stream is not shuffled
against a growing state: no stream-stream join, no watermark needed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from chronoleaf.operators.lookup import key_lookup


def stream_lookup(requests: DataFrame, snapshot: DataFrame, request_keys, snapshot_keys,
                  features=None, rename=None) -> DataFrame:
    if not requests.isStreaming:
        raise ValueError("requests must be a streaming DataFrame")
    # the static snapshot side is size-checked before it may be broadcast
    return key_lookup(requests, snapshot, request_keys, snapshot_keys, features, rename=rename)


def lookup_waves(requests: DataFrame, enrich: Callable[[DataFrame], DataFrame], path: str, checkpoint: str,
                 *, trigger: dict | None = None) -> StreamingQuery:
    """Start a stream that writes ``enrich(wave)`` of every wave to ``<path>/wave=<n>``.
    A wave that is run again after a failure overwrites its own folder, so each request is answered once."""
    if not requests.isStreaming:
        raise ValueError("requests must be a streaming DataFrame")

    def answer(wave: DataFrame, n: int) -> None:
        enrich(wave).write.mode("overwrite").parquet(f"{path}/wave={n}")

    return (requests.writeStream.foreachBatch(answer).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())
