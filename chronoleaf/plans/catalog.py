"""Keyed feature tables in the Spark catalog.

Storage: an external parquet catalog table per feature table under
``<root>/<database>/<table>``; primary keys, timestamp key, writer kind and
online mode live in ``TBLPROPERTIES``, the description in ``COMMENT``.

Merge (upsert) = append-only log + resolve on read: every write adds an
``_ingest_ts`` column; ``read_table`` keeps the last write per
(primary keys [+ timestamp key]).  ``compact`` rewrites a batch table resolved.
A table is written either by batch jobs or by one stream (a parquet stream
sink keeps a commit log that batch appends would bypass).

Publish = latest row per primary key (D5): a batch snapshot table, or a
stateless stream into an online log resolved the same way on read, so state
never grows inside a streaming query and a late event cannot overwrite a
newer value.  ``compact_online`` folds the log into a snapshot; later reads
scan only the snapshot and the log files published after it.

Compaction of a stream's log remembers the committed files it folded, not a
time: a file committed later is read however its rows are stamped, also by a
restarted driver whose clock is behind.  Folded files can then be removed.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoleaf.operators.latest import fold_recent, latest_per_key, resolve_merge_log
from chronoleaf.operators.lookup import scanned_bytes
from chronoleaf.operators.stats import duplicate_keys
from chronoleaf.session import checkpoint_root, delete_path

INGEST = "_ingest_ts"
PUBLISH = "_publish_ts"
_PROP = "chronoleaf"
BUCKET_BYTES = 128 << 20
_NAME = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


@dataclass(frozen=True)
class TableInfo:
    name: str
    primary_keys: tuple
    timestamp_key: str | None
    location: str
    writer: str
    merged: bool
    description: str | None

    @property
    def row_keys(self) -> list:
        return list(self.primary_keys) + ([self.timestamp_key] if self.timestamp_key else [])


def _as_list(x):
    if x is None:
        return []
    return [x] if isinstance(x, str) else list(x)


class FeatureCatalog:
    def __init__(self, spark: SparkSession, database: str = "features", root: str | None = None):
        if not _NAME.match(database):
            raise ValueError(f"bad database name {database!r}")
        self.spark = spark
        self.database = database
        self.root = (root or f"{checkpoint_root(spark)}/chronoleaf/warehouse").rstrip("/")

    # ---- database (S9) ----------------------------------------------------------
    def create_database(self) -> None:
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database} "
                       f"LOCATION '{self.root}/{self.database}.db'")

    def drop_database(self, cascade: bool = False) -> None:
        self.spark.sql(f"DROP DATABASE {self.database}{' CASCADE' if cascade else ''}")

    def qualified(self, name: str) -> str:
        if not _NAME.match(name):
            raise ValueError(f"bad table name {name!r}")
        return f"{self.database}.{name}"

    def location(self, name: str) -> str:
        return f"{self.root}/{self.database}.db/{name}"

    def exists(self, name: str) -> bool:
        return self.spark.catalog.tableExists(self.qualified(name))

    # ---- create (S4, S5) -------------------------------------------------------
    def create_table(self, name: str, primary_keys, timestamp_keys=None, df: DataFrame | None = None,
                     schema: T.StructType | None = None, description: str | None = None,
                     on_duplicate: str = "error") -> TableInfo:
        pks = _as_list(primary_keys)
        ts_keys = _as_list(timestamp_keys)
        if not pks:
            raise ValueError("at least one primary key is required")
        if len(ts_keys) > 1:
            raise ValueError("at most one timestamp key")
        ts_key = ts_keys[0] if ts_keys else None
        if (df is None) == (schema is None):
            raise ValueError("give exactly one of df= or schema=")
        if on_duplicate not in ("error", "any", "latest"):
            raise ValueError("on_duplicate must be 'error', 'any' or 'latest'")
        self.create_database()
        if self.exists(name):
            raise ValueError(f"feature table {self.qualified(name)} already exists")
        source_schema = df.schema if df is not None else schema
        missing = [k for k in pks + ts_keys if k not in source_schema.fieldNames()]
        if missing:
            raise ValueError(f"key columns missing from the data: {missing}")
        if INGEST in source_schema.fieldNames():
            raise ValueError(f"{INGEST} is reserved")
        loc = self.location(name)
        ddl_cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source_schema.fields)
        props = {f"{_PROP}.primary_keys": ",".join(pks), f"{_PROP}.writer": "none",
                 f"{_PROP}.merged": "false"}
        if ts_key:
            props[f"{_PROP}.timestamp_key"] = ts_key
        comment = f" COMMENT '{_sql_str(description)}'" if description else ""
        self.spark.sql(
            f"CREATE TABLE {self.qualified(name)} ({ddl_cols}, `{INGEST}` timestamp) USING parquet"
            f" LOCATION '{loc}'{comment} TBLPROPERTIES ({_props_sql(props)})")
        if df is not None:
            row_keys = pks + ([ts_key] if ts_key else [])
            data = df
            if on_duplicate == "any":
                data = latest_per_key(df, row_keys, [c for c in df.columns if c not in row_keys])
            self._append_batch(name, data)
            if on_duplicate != "any":
                dup = duplicate_keys(self._raw(name), row_keys).limit(1).collect()
                if dup and on_duplicate == "latest":
                    # only data that has duplicates pays for a second write
                    self._set_props(name, merged="true")
                    self.compact(name)
                elif dup:
                    self.drop_table(name)
                    raise ValueError(f"duplicate keys {row_keys} in feature table data, e.g. {dup[0]}")
        return self.get_table(name)

    def get_table(self, name: str) -> TableInfo:
        q = self.qualified(name)
        props = {r["key"]: r["value"] for r in self.spark.sql(f"SHOW TBLPROPERTIES {q}").collect()}
        desc = self.spark.catalog.getTable(q).description
        return TableInfo(q, tuple(props[f"{_PROP}.primary_keys"].split(",")),
                         props.get(f"{_PROP}.timestamp_key"), self.location(name),
                         props.get(f"{_PROP}.writer", "none"),
                         props.get(f"{_PROP}.merged", "false") == "true", desc)

    def _set_props(self, name: str, **props) -> None:
        kv = {f"{_PROP}.{k}": v for k, v in props.items()}
        self.spark.sql(f"ALTER TABLE {self.qualified(name)} SET TBLPROPERTIES ({_props_sql(kv)})")

    # ---- read ------------------------------------------------------------------
    def _raw(self, name: str) -> DataFrame:
        self.spark.catalog.refreshTable(self.qualified(name))
        return self.spark.table(self.qualified(name))

    def _props(self, name: str) -> dict:
        return {r["key"]: r["value"]
                for r in self.spark.sql(f"SHOW TBLPROPERTIES {self.qualified(name)}").collect()}

    def read_table(self, name: str) -> DataFrame:
        """The table as of now: one row per key (merge log resolved).  A compacted
        stream table reads its snapshot plus the log rows written after it."""
        info = self.get_table(name)
        raw = self._raw(name)
        if info.writer == "stream":
            snap = self._props(name).get(f"{_PROP}.table_snapshot")
            if snap:
                cols = [c for c in raw.columns if c != INGEST]
                return self._fold(snap, raw, info.row_keys, [INGEST], cols + [INGEST]).select(*cols)
        if info.merged or info.writer == "stream":
            return resolve_merge_log(raw, info.row_keys, INGEST)
        return raw.drop(INGEST)

    # ---- write (S6) ------------------------------------------------------------
    def _append_batch(self, name: str, df: DataFrame) -> None:
        info = self.get_table(name)
        if info.writer == "stream":
            raise ValueError(f"{info.name} is written by a stream; batch appends would be invisible")
        cols = [c for c in self._raw(name).columns if c != INGEST]
        (df.select(*cols).withColumn(INGEST, F.current_timestamp())
         .write.mode("append").insertInto(self.qualified(name)))
        if info.writer != "batch":
            self._set_props(name, writer="batch")

    def write_table(self, name: str, df: DataFrame, mode: str = "merge",
                    checkpoint_location: str | None = None, trigger: dict | None = None,
                    max_files_per_trigger: int | None = None):
        """Batch: returns None.  Streaming ``df``: starts and returns the StreamingQuery."""
        info = self.get_table(name)
        if mode not in ("merge", "overwrite"):
            raise ValueError("mode must be 'merge' or 'overwrite'")
        if df.isStreaming:
            if mode != "merge":
                raise ValueError("a streaming write can only merge")
            if info.writer == "batch":
                raise ValueError(f"{info.name} already holds batch data; stream into a new table")
            if not checkpoint_location:
                raise ValueError("a streaming write needs checkpoint_location")
            cols = [c for c in self._raw(name).columns if c != INGEST]
            self._set_props(name, writer="stream", merged="true")
            w = (df.select(*cols).withColumn(INGEST, F.current_timestamp())
                 .writeStream.format("parquet").outputMode("append")
                 .option("checkpointLocation", checkpoint_location)
                 .option("path", info.location))
            w = w.trigger(**(trigger or {"availableNow": True}))
            return w.start()
        if mode == "overwrite":
            if info.writer == "stream":
                raise ValueError(f"{info.name} is written by a stream")
            cols = [c for c in self._raw(name).columns if c != INGEST]
            (df.select(*cols).withColumn(INGEST, F.current_timestamp())
             .write.mode("overwrite").insertInto(self.qualified(name), overwrite=True))
            self._set_props(name, writer="batch", merged="false")
            return None
        self._append_batch(name, df)
        self._set_props(name, merged="true")
        return None

    def compact(self, name: str, staging: str | None = None) -> None:
        """Rewrite a batch merge log resolved (bounded growth).  The resolved data is
        first written to a staging table, so the source is never read and
        overwritten by one job."""
        info = self.get_table(name)
        if info.writer == "stream":
            self._compact_stream_table(name, info)
            return
        if info.writer != "batch" or not info.merged:
            return
        resolved = self.read_table(name)
        stage = staging or f"{name}__compact"
        loc = self.location(stage)
        resolved.write.mode("overwrite").parquet(loc)
        self.write_table(name, self.spark.read.parquet(loc), mode="overwrite")
        delete_path(self.spark, loc)

    def _compact_stream_table(self, name: str, info: TableInfo) -> None:
        """A stream-written table cannot be rewritten in place (its sink keeps a
        commit log): fold its committed files into a versioned snapshot."""
        raw = self._raw(name)
        cols = [c for c in raw.columns if c != INGEST]
        self._compact_log(name, "table", f"{self.location(name)}__snap", raw, info.row_keys,
                          [INGEST], cols + [INGEST])

    # ---- folding stream logs -------------------------------------------------------
    def _folded(self, snap: str | None) -> set[str]:
        """Names of the log files a snapshot holds (as many as the log's own listing has)."""
        return {r["file"] for r in self.spark.read.parquet(f"{snap}/files").collect()} if snap else set()

    def _fold(self, snap: str | None, log: DataFrame, keys, order, columns) -> DataFrame:
        """The snapshot with the log files committed after it folded in."""
        done = self._folded(snap)
        fresh = [f for f in log.inputFiles() if f not in done]
        if snap and not fresh:
            return self.spark.read.parquet(f"{snap}/rows").select(*columns)
        recent = self.spark.read.schema(log.schema).parquet(*map(unquote, fresh)) if fresh else log.limit(0)
        if not snap:
            return latest_per_key(recent, keys, order, columns)
        return fold_recent(self.spark.read.parquet(f"{snap}/rows"), recent.select(*columns), keys, order, columns)

    def _compact_log(self, name: str, kind: str, folder: str, log: DataFrame, keys, order, columns,
                     keep_versions: int = 2) -> None:
        """Fold the committed files of ``log`` into the next snapshot version, then point
        the table at it.  Of the versions before, the newest ``keep_versions`` stay for
        readers that still hold them."""
        props = self._props(name)
        snap = props.get(f"{_PROP}.{kind}_snapshot")
        committed = log.inputFiles()
        if set(committed) <= self._folded(snap):
            return
        version = int(props.get(f"{_PROP}.{kind}_version", "0")) + 1
        path = f"{folder}/v={version}"
        delete_path(self.spark, path)            # what a failed compaction may have left
        self._fold(snap, log, keys, order, columns).write.parquet(f"{path}/rows")
        (self.spark.createDataFrame([(f,) for f in committed], "file string").coalesce(1)
         .write.parquet(f"{path}/files"))
        self._set_props(name, **{f"{kind}_snapshot": path, f"{kind}_version": version})
        if version > keep_versions + 1:
            delete_path(self.spark, f"{folder}/v={version - keep_versions - 1}")

    def remove_folded(self, name: str, online: bool = False) -> int:
        """Delete the log files that the snapshot holds; returns their number.  Call it
        when no reader of an older view and no publish stream still needs them."""
        snap = self._props(name).get(f"{_PROP}.{'online' if online else 'table'}_snapshot")
        return sum(delete_path(self.spark, unquote(f)) for f in self._folded(snap))

    # ---- drop (S9, S10) ----------------------------------------------------------
    def drop_table(self, name: str) -> None:
        q = self.qualified(name)
        version = int(self._props(name).get(f"{_PROP}.publish_version", "0")) if self.exists(name) else 0
        self.spark.sql(f"DROP TABLE IF EXISTS {q}")
        delete_path(self.spark, self.location(name))
        # one more than the live version: a publish that failed may have left it
        for extra in [f"{name}__online_log", *[_online_name(name, v) for v in range(1, version + 2)]]:
            self._drop_data(extra)
        delete_path(self.spark, f"{self.location(name)}__online_snap")
        delete_path(self.spark, f"{self.location(name)}__snap")

    def _drop_data(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.qualified(name)}")
        delete_path(self.spark, self.location(name))

    # ---- publish (S7, S8) --------------------------------------------------------
    def snapshot(self, name: str) -> DataFrame:
        """Latest row per primary key of a feature table (A3)."""
        info = self.get_table(name)
        if not (info.merged or info.writer == "stream"):
            data = self.read_table(name)
            if not info.timestamp_key:
                return data
            return latest_per_key(data, list(info.primary_keys), [info.timestamp_key])
        if f"{_PROP}.table_snapshot" in self._props(name):
            # one row per (key, time) already: the compacted rows and what came after
            return latest_per_key(self.read_table(name), list(info.primary_keys), _as_list(info.timestamp_key))
        # one aggregation straight off the log: newest time, then newest write
        return _latest_from_log(self._raw(name), info)

    def publish_table(self, name: str, streaming: bool = False,
                      checkpoint_location: str | None = None, trigger: dict | None = None,
                      buckets: int | None = None, keep_versions: int = 2):
        """Batch: write the next version ``<name>__online_v<n>``, bucketed by the primary
        keys into ``buckets`` so key lookups against a snapshot too large to broadcast
        shuffle only the request side; only then point the table at it.  By default a
        bucket takes about BUCKET_BYTES of the feature table's files, up to the session's
        shuffle partitions, and a table that fits in one is written without buckets.  Of the versions before, the newest ``keep_versions``
        stay for readers that still hold them.
        Streaming: start a query appending the feature table's new rows to
        ``<name>__online_log`` and return it."""
        info = self.get_table(name)
        if not streaming:
            version = int(self._props(name).get(f"{_PROP}.publish_version", "0")) + 1
            online = _online_name(name, version)
            self._drop_data(online)          # what a failed publish may have left; never the live one
            n = buckets or self._bucket_count(name)
            pks = list(info.primary_keys)
            snap = self.snapshot(name)
            if n > 1 and not (info.merged or info.writer == "stream" or info.timestamp_key):
                # a plain scan, not an aggregate by the keys: without this each write
                # task would emit a file for every bucket; hashing by the keys into n
                # partitions puts one bucket in each task (same hash as the bucket id)
                snap = snap.repartition(n, *pks)
            out = snap.write.format("parquet").option("path", self.location(online))
            (out.bucketBy(n, pks[0], *pks[1:]) if n > 1 else out).saveAsTable(self.qualified(online))
            self._set_props(name, online="batch", publish_version=version)
            if version > keep_versions + 1:
                self._drop_data(_online_name(name, version - keep_versions - 1))
            return None
        if not checkpoint_location:
            raise ValueError("streaming publish needs checkpoint_location")
        log_name = f"{name}__online_log"
        cols = [c for c in self._raw(name).columns if c != INGEST]
        if not self.exists(log_name):
            schema = self._raw(name).select(*cols).schema
            ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
            self.spark.sql(f"CREATE TABLE {self.qualified(log_name)} ({ddl}, `{INGEST}` timestamp,"
                           f" `{PUBLISH}` timestamp) USING parquet LOCATION '{self.location(log_name)}'")
        self._set_props(name, online="stream")
        # keep the feature table's own write time: it orders rewrites of one (key, time)
        src = (self.spark.readStream.table(info.name)
               .select(*cols, INGEST, F.current_timestamp().alias(PUBLISH)))
        return (src.writeStream.format("parquet").outputMode("append")
                .option("checkpointLocation", checkpoint_location)
                .option("path", self.location(log_name))
                .trigger(**(trigger or {"availableNow": True})).start())

    def _bucket_count(self, name: str) -> int:
        """Buckets for a snapshot of a table: its files are an upper bound of the snapshot's."""
        most = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        size = scanned_bytes(self._raw(name))
        return most if size is None else max(1, min(most, -(-size // BUCKET_BYTES)))

    def read_online(self, name: str) -> DataFrame:
        """The published latest-value view of a feature table."""
        info = self.get_table(name)
        props = {r["key"]: r["value"]
                 for r in self.spark.sql(f"SHOW TBLPROPERTIES {info.name}").collect()}
        mode = props.get(f"{_PROP}.online")
        if mode == "batch":
            return self._raw(_online_name(name, int(props[f"{_PROP}.publish_version"])))
        if mode == "stream":
            log = self._raw(f"{name}__online_log")
            snap = props.get(f"{_PROP}.online_snapshot")
            if not snap:
                return _latest_from_log(log, info)
            cols = [c for c in log.columns if c not in (INGEST, PUBLISH)]
            return self._fold(snap, log, list(info.primary_keys), _log_order(info),
                              cols + [INGEST]).select(*cols)
        raise ValueError(f"{info.name} has not been published")

    def compact_online(self, name: str) -> None:
        """Fold a stream-published online log into a snapshot (one row per key),
        so reads stop re-resolving the whole log.  Safe while the publish stream
        runs: only committed files are folded."""
        info = self.get_table(name)
        props = {r["key"]: r["value"]
                 for r in self.spark.sql(f"SHOW TBLPROPERTIES {info.name}").collect()}
        if props.get(f"{_PROP}.online") != "stream":
            raise ValueError(f"{info.name} is not stream-published")
        log = self._raw(f"{name}__online_log")
        cols = [c for c in log.columns if c not in (INGEST, PUBLISH)]
        self._compact_log(name, "online", f"{self.location(name)}__online_snap", log,
                          list(info.primary_keys), _log_order(info), cols + [INGEST])


def _online_name(name: str, version: int) -> str:
    return f"{name}__online_v{version}"


def _log_order(info: TableInfo) -> list:
    return _as_list(info.timestamp_key) + [INGEST]


def _latest_from_log(log: DataFrame, info: TableInfo) -> DataFrame:
    cols = [c for c in log.columns if c not in (INGEST, PUBLISH)]
    return latest_per_key(log, list(info.primary_keys), _log_order(info), columns=cols + [INGEST]).select(*cols)


def _sql_str(s: str) -> str:
    return s.replace("\\", "\\\\").replace("'", "\\'")


def _props_sql(props: dict) -> str:
    return ", ".join(f"'{k}'='{_sql_str(str(v))}'" for k, v in props.items())
