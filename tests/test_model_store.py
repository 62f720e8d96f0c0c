import pytest
from pyspark.sql import functions as F

from tillcast.plans import model_store as MS
from tillcast.plans import training
from tillcast.sources.invoices import IngestionError


def put(spark, value):
    def write(folder):
        spark.createDataFrame([(value,)], "run int").write.parquet(f"{folder}/models")
        spark.createDataFrame([(value,)], "run int").write.parquet(f"{folder}/registry")
    return write


def seen(spark, folder):
    return {spark.read.parquet(f"{folder}/{part}").first()["run"] for part in ("models", "registry")}


def test_a_failure_between_the_writes_leaves_the_former_version(spark, tmp_path):
    path = str(tmp_path / "m")
    assert MS.current_folder(spark, path) is None
    with pytest.raises(IngestionError):
        training.load_models(spark, path)
    MS.publish(spark, path, put(spark, 1))

    def broken(folder):
        spark.createDataFrame([(2,)], "run int").write.parquet(f"{folder}/models")
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        MS.publish(spark, path, broken)
    assert seen(spark, MS.current_folder(spark, path)) == {1}
    assert training.load_registry(spark, path).first()["run"] == training.load_models(spark, path).first()["run"] == 1
    MS.publish(spark, path, put(spark, 3))
    assert seen(spark, MS.current_folder(spark, path)) == {3}


def test_readers_of_a_version_keep_it_and_old_ones_go(spark, tmp_path):
    path = str(tmp_path / "m")
    folders = [MS.publish(spark, path, put(spark, n), keep=2) for n in range(4)]
    assert seen(spark, folders[2]) == {2} and seen(spark, folders[3]) == {3}
    assert not any((tmp_path / "m" / "versions" / f.rsplit("/", 1)[1]).exists() for f in folders[:2])
    assert [r["number"] for r in MS.versions(spark, path).orderBy("number").collect()] == [1, 2, 3, 4]
    with pytest.raises(ValueError):
        MS.publish(spark, path, put(spark, 9), keep=0)


def test_two_runs_that_end_at_once_agree_on_one_version(spark, tmp_path):
    path = str(tmp_path / "m")
    first = MS.publish(spark, path, put(spark, 1))
    rows = MS.versions(spark, path).withColumn("version", F.concat(F.lit("zz"), "version"))
    rows.write.mode("append").json(f"{path}/manifest")
    assert MS.current_folder(spark, path) == f"{path}/versions/zz{first.rsplit('/', 1)[1]}"
