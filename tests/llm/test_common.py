import os
from types import SimpleNamespace

import pytest

from scholarloom.llm import common


def test_no_folder_of_one_machine_on_a_cluster():
    conf = SimpleNamespace(get=lambda key, default=None: default)
    spark = SimpleNamespace(sparkContext=SimpleNamespace(getConf=lambda: conf, master="spark://host:7077"), conf=conf)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        common.shared_dir(spark)


def test_intermediate_tables_go(spark):
    scratch = common.Scratch(spark, "test")
    df = scratch.written(spark.range(10).withColumnRenamed("id", "x y"), "numbers")
    folder = scratch.folder.removeprefix("file://")
    assert df.count() == 10 and df.columns == ["x y"] and scratch.folder.startswith(common.run_folder(spark)) and os.path.isdir(folder)
    scratch.close()
    assert not os.path.exists(folder) and common.run_folder(spark) == common.run_folder(spark)


def test_lower_case_of_a_to_z_only(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("ABC xyz",), ("ÀBC İ",), ("",), (None,)], "t string")
    assert [r[0] for r in df.select(common.ascii_lower(F.col("t"))).collect()] == ["abc xyz", "Àbc İ", "", None]
