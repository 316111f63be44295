"""Model with on-demand preprocessing, batch scoring and a versioned registry
(L1-L3, U2, U3, P7, P8, A2, S13).

The reference collects the training frame to the driver and fits a boosted
tree there.  Here everything stays distributed: one ``PipelineModel`` of

1. ``SQLTransformer`` - on-demand ``distance`` plus NULL handling, with the
   training medians baked in as literals (same preprocessing at fit and
   predict time, saved with the model);
2. ``VectorAssembler`` over all feature columns;
3. ``GBTClassifier`` (binary, 5 rounds, depth 5 = at most 32 leaves).

Scoring appends ``prediction`` = P(label = 1) as float, like the reference's
raw booster output; ``threshold_predictions`` turns it into a boolean.
"""

from __future__ import annotations

import json

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoleaf.functions.flags import threshold
from chronoleaf.operators.stats import accuracy, exact_medians
from chronoleaf.plans.ondemand import LOCATION_COLUMNS, distance_transform_sql
from chronoleaf.plans.training import Lookup, apply_lookups
from chronoleaf.session import checkpoint_root, materialize

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
            T.DecimalType, T.BooleanType)


class OnDemandModel:
    """Estimator: ``fit(train_df, label)`` -> :class:`FittedModel`."""

    def __init__(self, max_iter: int = 5, max_depth: int = 5, step_size: float = 0.1,
                 seed: int = 42, exclude=()):
        self.max_iter, self.max_depth, self.step_size, self.seed = max_iter, max_depth, step_size, seed
        self.exclude = list(exclude)

    def fit(self, train_df: DataFrame, label: str) -> "FittedModel":
        feats = [f.name for f in train_df.schema.fields
                 if f.name != label and f.name not in self.exclude
                 and isinstance(f.dataType, _NUMERIC)]
        if not feats:
            raise ValueError("no numeric feature columns")
        # the training frame feeds several passes (medians, split finding, boosting):
        # materialise it once in the shared checkpoint folder instead of recomputing
        # its lookups each time; the checkpoint also survives lost executors
        data = materialize(train_df.withColumn("__label", F.col(label).cast("double"))
                           .where(F.col("__label").isNotNull()), "training-frame")
        medians = exact_medians(data, feats)
        pre = _preprocess_sql(feats, medians)
        prepare = PipelineModel([
            SQLTransformer(statement=pre),
            VectorAssembler(inputCols=[f"__f_{c}" for c in feats] + ["__distance"] +
                            [f"__m_{c}" for c in feats], outputCol="__features"),
        ])
        boosting = (GBTClassifier(labelCol="__label", featuresCol="__features", maxIter=self.max_iter,
                                  maxDepth=self.max_depth, stepSize=self.step_size, seed=self.seed,
                                  predictionCol="__gbt_pred")
                    .setProbabilityCol("__prob").setRawPredictionCol("__raw"))
        # three passes read the vectors before the trees have their own form of them
        vectors = materialize(prepare.transform(data).select("__label", "__features"), "training-vectors")
        model = PipelineModel([*prepare.stages, boosting.fit(vectors)])
        return FittedModel(model, feats, label, medians)


def _preprocess_sql(feats, medians) -> str:
    loc_medians = {c: medians.get(c) for c in LOCATION_COLUMNS}
    parts = ["*"]
    for c in feats:
        m = medians.get(c)
        fill = 0.0 if m is None else float(m)
        parts.append(f"coalesce(CAST(`{c}` AS DOUBLE), CAST({fill!r} AS DOUBLE)) AS `__f_{c}`")
        parts.append(f"CAST((`{c}` IS NULL) AS DOUBLE) AS `__m_{c}`")
    if all(c in feats for c in LOCATION_COLUMNS):
        source = f"({distance_transform_sql(loc_medians, name='__od_distance')})"
        dist = "__od_distance"
    else:
        source, dist = "__THIS__", "CAST(NULL AS DOUBLE)"
    parts.append(f"coalesce({dist}, CAST(0.0 AS DOUBLE)) AS `__distance`")
    return f"SELECT {', '.join(parts)} FROM {source}"


def _tree_sql(node) -> str:
    """A regression tree as SQL over the array ``x`` (at most 2^depth leaves, whatever the data)."""
    if node.subtreeDepth() == 0:
        return f"{node.prediction()!r}D"
    split = node.split()
    return (f"if(x[{split.featureIndex()}] <= {split.threshold()!r}D, {_tree_sql(node.leftChild())}, "
            f"{_tree_sql(node.rightChild())})")


class FittedModel:
    def __init__(self, model: PipelineModel, features, label, medians, spec: dict | None = None):
        self.model, self.features, self.label, self.medians = model, list(features), label, medians
        self.spec = spec or {}

    def transform(self, df: DataFrame, result_type: str = "float", features: str | None = None) -> DataFrame:
        """``df`` with ``prediction``, and with the feature vector under the name ``features`` if one is given.

        The cast is an array function, which is no part of whole-stage code: what a later model adds to the plan
        starts a method of its own, and the JVM compiles none of more than 8,000 bytes."""
        missing = [c for c in self.features if c not in df.columns]
        if missing:
            raise ValueError(f"scoring input lacks feature columns {missing}")
        out = self.model.transform(df)
        prob = F.transform(vector_to_array("__prob"), lambda p: p.cast(result_type)).getItem(1)
        kept = [F.col("__features").alias(features)] if features else []
        return out.select(*df.columns, prob.alias("prediction"), *kept)

    def tree_walk(self, df: DataFrame, name: str = "walked", features: str | None = None) -> DataFrame:
        """P(label = 1) by a second way: the fitted trees written out as one SQL expression over the feature
        vector (nested conditions by split, weighted sum, logistic), beside the columns of ``df``.  ``features``: the
        column of ``df`` that holds the vector (see ``transform``); without it the vector is made here.

        The trees are the body of an array function: the JVM would not compile them as a part of whole-stage code."""
        boosted = self.model.stages[-1]
        out = df if features else PipelineModel(self.model.stages[:-1]).transform(df)
        margin = " + ".join(f"{w!r}D * ({_tree_sql(t._java_obj.rootNode())})"
                            for t, w in zip(boosted.trees, boosted.treeWeights))
        walk = F.expr(f"transform(__x, x -> 1 / (1 + exp(-2 * ({margin}))))").getItem(0)
        return (out.withColumn("__x", F.array(vector_to_array(features or "__features")))
                .withColumn(name, walk).select(*df.columns, name))

    # ---- persistence (S13) -------------------------------------------------------
    def save(self, spark: SparkSession, path: str) -> None:
        self.model.write().overwrite().save(f"{path}/model")
        meta = json.dumps({"features": self.features, "label": self.label,
                           "medians": self.medians, "spec": self.spec}, sort_keys=True)
        (spark.createDataFrame([(meta,)], "value string").coalesce(1)
         .write.mode("overwrite").text(f"{path}/meta"))

    @staticmethod
    def load(spark: SparkSession, path: str) -> "FittedModel":
        meta = json.loads(spark.read.text(f"{path}/meta").first()["value"])
        return FittedModel(PipelineModel.load(f"{path}/model"), meta["features"], meta["label"],
                           meta["medians"], meta.get("spec"))


class ModelRegistry:
    """Versioned model bundles under ``<root>/<name>/v=<N>`` (model + lookup spec)."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = (root or f"{checkpoint_root(spark)}/chronoleaf/models").rstrip("/")

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def versions(self, name: str) -> list[int]:
        p, fs = self._fs(f"{self.root}/{name}")
        if not fs.exists(p):
            return []
        out = []
        for st in fs.listStatus(p):
            leaf = st.getPath().getName()
            if st.isDirectory() and leaf.startswith("v="):
                out.append(int(leaf[2:]))
        return sorted(out)

    def latest_version(self, name: str) -> int:
        v = self.versions(name)
        if not v:
            raise ValueError(f"no versions of model {name!r}")
        return v[-1]

    def log_model(self, name: str, model: FittedModel, training_set=None) -> int:
        version = (self.versions(name) or [0])[-1] + 1
        if training_set is not None:
            model.spec = training_set.spec()
        model.save(self.spark, f"{self.root}/{name}/v={version}")
        return version

    def load(self, name: str, version: int | None = None) -> FittedModel:
        version = version or self.latest_version(name)
        return FittedModel.load(self.spark, f"{self.root}/{name}/v={version}")

    def score_batch(self, catalog, model_uri: str, df: DataFrame, result_type: str = "float"
                    ) -> DataFrame:
        """``models:/<name>/<version|latest>``: look up the training features for ``df``
        (same lookups as at training time), then append ``prediction``."""
        name, version = _parse_uri(model_uri)
        model = self.load(name, None if version == "latest" else int(version))
        lookups = [Lookup.from_dict(d) for d in (model.spec or {}).get("lookups", [])]
        enriched = apply_lookups(catalog, df, lookups)
        return model.transform(enriched, result_type)


def _parse_uri(uri: str):
    if not uri.startswith("models:/"):
        raise ValueError("model uri must look like models:/<name>/<version>")
    name, _, version = uri[len("models:/"):].partition("/")
    return name, version or "latest"


def threshold_predictions(scored: DataFrame, cut: float = 0.2) -> DataFrame:
    """P7 + P8: prediction -> raw_prediction, prediction = raw >= cut (NULL -> False)."""
    s = scored.withColumnRenamed("prediction", "raw_prediction")
    return s.withColumn("prediction", threshold("raw_prediction", cut))


def scored_accuracy(scored: DataFrame, label: str, cut: float = 0.2) -> DataFrame:
    return accuracy(threshold_predictions(scored, cut), label, "prediction")
