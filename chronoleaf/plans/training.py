"""Feature lookups and training-set assembly.

``create_training_set`` applies each :class:`Lookup` to the label rows:
a point-in-time lookup when both the feature table and the lookup have a time
key, a plain key lookup otherwise (a time-keyed table looked up without a
label time uses its latest row per key).  Exactly one output row per label row.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame

from chronoleaf.operators.asof import AsOf, asof_lookups
from chronoleaf.operators.latest import latest_per_key
from chronoleaf.operators.lookup import key_lookup


@dataclass(frozen=True)
class Lookup:
    table_name: str
    lookup_key: tuple | list | str
    timestamp_lookup_key: str | None = None
    feature_names: tuple | list | None = None
    rename: dict | None = field(default=None, hash=False)

    def keys(self) -> list:
        k = self.lookup_key
        return [k] if isinstance(k, str) else list(k)

    def to_dict(self) -> dict:
        d = asdict(self)
        d["lookup_key"] = self.keys()
        d["feature_names"] = list(self.feature_names) if self.feature_names else None
        return d

    @staticmethod
    def from_dict(d: dict) -> "Lookup":
        return Lookup(d["table_name"], tuple(d["lookup_key"]), d.get("timestamp_lookup_key"),
                      tuple(d["feature_names"]) if d.get("feature_names") else None, d.get("rename"))


def apply_lookups(catalog, df: DataFrame, lookups, *,
                  bucket_seconds: int | None = None) -> DataFrame:
    """All lookups on ``df``, their features in the order given.  Point-in-time lookups go first, one pass per
    leading key, so that they shuffle narrow rows; a lookup by a column that another one brings waits for it."""
    out, columns, timed, plain = df, list(df.columns), [], []

    def joined(now: DataFrame) -> DataFrame:
        own = all({*lk.left_keys, lk.left_ts} <= set(df.columns) for lk in timed)
        if timed:
            now = asof_lookups(now, timed, bucket_seconds=bucket_seconds, left_key_source=df if own else None)
        for table, keys, pks, feats, rename in plain:
            now = key_lookup(now, table, keys, pks, feats, rename=rename)
        timed.clear()
        plain.clear()
        return now

    for lk in lookups:
        info = catalog.get_table(lk.table_name)
        table = catalog.read_table(lk.table_name)
        pks = list(info.primary_keys)
        if len(pks) != len(lk.keys()):
            raise ValueError(f"{info.name} has keys {pks}, lookup gives {lk.keys()}")
        feats = list(lk.feature_names) if lk.feature_names else \
            [c for c in table.columns if c not in info.row_keys]
        names = [(lk.rename or {}).get(c, c) for c in feats]
        clash = set(names) & set(columns)
        if clash:
            raise ValueError(f"lookup output collides with label columns {sorted(clash)}; pass rename=")
        columns += names
        by_time = info.timestamp_key and lk.timestamp_lookup_key
        if not {*lk.keys(), *([lk.timestamp_lookup_key] if by_time else [])} <= set(out.columns):
            out = joined(out)
        if by_time:
            timed.append(AsOf(table, lk.keys(), pks, lk.timestamp_lookup_key, info.timestamp_key, feats, lk.rename))
        else:
            if info.timestamp_key:
                table = latest_per_key(table, pks, [info.timestamp_key])
            plain.append((table, lk.keys(), pks, feats, lk.rename))
    return joined(out).select(*columns)


class TrainingSet:
    def __init__(self, catalog, df: DataFrame, feature_lookups, exclude_columns=(), label=None):
        self.catalog = catalog
        self.labels = df
        self.feature_lookups = list(feature_lookups)
        self.exclude_columns = list(exclude_columns or [])
        self.label = label
        if label is not None and label not in df.columns:
            raise ValueError(f"label column {label!r} not in the label rows")
        if label in self.exclude_columns:
            raise ValueError("the label cannot be excluded")

    def load_df(self) -> DataFrame:
        joined = apply_lookups(self.catalog, self.labels, self.feature_lookups)
        keep = [c for c in joined.columns if c not in self.exclude_columns and c != self.label]
        return joined.select(*keep, *([self.label] if self.label else []))

    def spec(self) -> dict:
        return {"lookups": [lk.to_dict() for lk in self.feature_lookups],
                "exclude_columns": self.exclude_columns, "label": self.label}

    def spec_json(self) -> str:
        return json.dumps(self.spec(), sort_keys=True)


def create_training_set(catalog, df: DataFrame, feature_lookups, exclude_columns=(),
                        label=None) -> TrainingSet:
    return TrainingSet(catalog, df, feature_lookups, exclude_columns, label)
