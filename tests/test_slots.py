"""One-hot vectors leave no object for each slot on the driver, and equal those of Spark's own encoder and assembler."""

import json

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import functions as F

from lotwise import schema as S
from lotwise.ml import features as E
from lotwise.ml.levels import Levels, SlotVector
from lotwise.sources.staging import stage


@pytest.fixture(scope="module")
def rows(spark):
    more = [(f"area {i % 40}", f"state {i % 3}", None if i % 7 == 0 else "t", float(i % 5), float(i), 0.5 * i, i % 2, 100.0 + i) for i in range(200)]
    names = f"Area string, State string, Tenure string, `{S.TX}` double, `{S.LOG_SIZE}` double, `{S.DENSITY}` double, `{S.TYPE_PREFIX}Small` int, `{S.TARGET}` double"
    return stage(spark.createDataFrame(more, names))


def test_features_name_no_slots_and_equal_assembled_vectors(rows):
    rows = rows.fillna("none", ["Tenure"])
    features = E.FEATURE_SETS["svr"]
    encoder = E.fit_encoder(rows, features)
    encoded = encoder.transform(rows.unionByName(rows.limit(1).withColumn("Area", F.lit("nobody"))))
    assert not json.loads(encoded.schema["features"].json())["metadata"]
    places = [f"_index_{c}" for c in features.categorical]
    hot = OneHotEncoder(inputCols=places, outputCols=[f"_onehot_{c}" for c in features.categorical], handleInvalid="keep")
    hot = hot.fit(Levels(inputCols=list(features.categorical), by="name", labelCol=E.LABEL).fit(E.with_label(rows)).transform(rows))
    inputs = [c.replace("_index_", "_onehot_") for c in encoder.stages[-1].getInputCols()]
    both = VectorAssembler(inputCols=inputs, outputCol="assembled").transform(hot.transform(encoded)).select("features", "assembled").collect()
    assert len(both) == 201 and all((r["features"].toArray() == r["assembled"].toArray()).all() for r in both)


def test_one_hot_vectors_name_no_slots(rows):
    model = Pipeline(stages=E.one_hot_stages(["Area", "Tenure"])).fit(E.with_label(rows))
    vectors = model.transform(rows)
    assert not json.loads(vectors.schema["_onehot_Area"].json())["metadata"]
    found = vectors.select("Tenure", "_onehot_Area", "_onehot_Tenure").collect()
    assert all(r["_onehot_Area"].size == 40 and r["_onehot_Area"].toArray().sum() == 1 for r in found)
    assert all(r["_onehot_Tenure"].toArray().tolist() == [float(r["Tenure"] is not None)] for r in found)


def test_a_missing_number_is_an_error(rows, tmp_path):
    SlotVector(inputCols=["a", "b"], levels=["b"], widths=[0, 3], outputCol="v").write().overwrite().save(f"{tmp_path}/v")
    stage_ = SlotVector.load(f"{tmp_path}/v")
    spark = rows.sparkSession
    assert stage_.transform(spark.sql("SELECT 2 AS a, 1D AS b")).first()["v"].toArray().tolist() == [2, 0, 1, 0]
    with pytest.raises(Exception, match="a has no value"):
        stage_.transform(spark.sql("SELECT CAST(NULL AS INT) AS a, 1D AS b")).collect()
