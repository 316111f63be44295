"""Generated code stays below the 8,000 bytes a method may have for the JVM to compile it; larger ones run interpreted,
many times slower a row."""

import re

import pytest
from pyspark.sql import functions as F

from chronoleaf.operators import stats
from chronoleaf.plans.model import OnDemandModel

COMPILED = 8000


@pytest.fixture
def largest(spark, capsys):
    """Size of the largest generated method of a plan."""
    def size(df):
        adaptive = spark.conf.get("spark.sql.adaptive.enabled")
        spark.conf.set("spark.sql.adaptive.enabled", "false")   # an adaptive plan has no code before it runs
        try:
            capsys.readouterr()
            df.select("*").explain(mode="codegen")
        finally:
            spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        return max(int(n) for n in re.findall(r"maxMethodCodeSize:(-?\d+)", capsys.readouterr().out))
    return size


@pytest.fixture(scope="module")
def frame(spark, tmp_path_factory):
    """Labels that no split explains, so all trees grow to their depth."""
    path = f"file://{tmp_path_factory.mktemp('frame')}/rows"
    wild = lambda i, n: F.pmod(F.xxhash64("id", F.lit(i)), F.lit(n)).cast("double")
    (spark.range(3000).select(
        F.col("id").alias("event_id"),
        *[F.when(wild(i + 50, 9) > 0, wild(i, 1000)).alias(f"x{i}") for i in range(4)],
        (wild(10, 100) - 50).alias("user_latitude"), (wild(11, 300) - 150).alias("user_longitude"),
        (wild(12, 120) - 55).alias("latitude"), (wild(13, 340) - 170).alias("longitude"),
        (wild(14, 3) == 0).alias("purchased")).write.parquet(path))
    return spark.read.parquet(path)


def test_models_scored_one_after_another_stay_compiled(spark, frame, largest):
    model = OnDemandModel(exclude=["event_id"]).fit(frame, "purchased")
    assert all(t.depth == 5 for t in model.model.stages[-1].trees)
    once = model.transform(frame)
    twice = model.transform(once.withColumnRenamed("prediction", "loaded"))
    assert largest(once) < COMPILED
    assert largest(twice) < COMPILED
    assert largest(model.tree_walk(frame)) < COMPILED
    assert largest(model.tree_walk(twice)) < COMPILED


def test_walk_takes_the_vector_of_the_scoring(spark, frame):
    model = OnDemandModel(exclude=["event_id"]).fit(frame, "purchased")
    scored = model.transform(frame, features="vector")
    assert scored.columns == [*frame.columns, "prediction", "vector"]
    rows = model.tree_walk(model.tree_walk(scored, "given", features="vector"), "made").collect()
    assert len(rows) == 3000 and len({r.given for r in rows}) > 10
    assert all(r.given == r.made and abs(r.given - r.prediction) < 1e-6 for r in rows)


def test_median_keys_stay_compiled(spark, frame, largest, monkeypatch):
    cols, sizes, write = [c for c in frame.columns if c not in ("event_id", "purchased")], [], stats.materialize

    def sized(df, purpose):
        sizes.append(largest(df))
        return write(df, purpose)

    monkeypatch.setattr(stats, "materialize", sized)
    found = stats.exact_medians(frame, cols, local_limit=0)
    assert found == stats.exact_medians(frame, cols)
    assert len(sizes) == 1 and sizes[0] < COMPILED
