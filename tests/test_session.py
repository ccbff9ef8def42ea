"""What a written table leaves behind: no shuffle files, and nothing once it is released."""
import glob
import os

import pytest
from pyspark.sql import functions as F

from contrail.plans import catalog_models
from contrail.session import checkpoint_dir, cut_lineage, release

from driver_tables import SF_SMALL


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f for f in (files.apply(i).getName() for i in range(files.size())) if f.startswith("shuffle_")}


def local(path):
    return path.removeprefix("file://").removeprefix("file:")


def test_shuffle_files_go_with_the_write(spark):
    rows = spark.range(1000).repartition(3, "id").groupBy((F.col("id") % 7).alias("k")).count()
    before = shuffle_files(spark)
    table = cut_lineage(rows)
    assert not shuffle_files(spark) - before
    assert table.count() == rows.count() == cut_lineage(rows).count() == 7  # the frame can be read and written again


def test_release(spark):
    table = cut_lineage(spark.range(10).coalesce(1))
    path = local(os.path.dirname(table.inputFiles()[0]))
    assert os.path.isdir(path)
    release(table)
    assert not os.path.exists(path)


def test_release_takes_tables_of_its_own_only(spark, tmp_path):
    spark.range(10).write.parquet(str(tmp_path / "given"))
    with pytest.raises(ValueError):
        release(spark.read.parquet(str(tmp_path / "given")))
    assert spark.read.parquet(str(tmp_path / "given")).count() == 10


def test_scoring_keeps_one_table_of_flights(spark):
    def tables():
        return set(glob.glob(os.path.join(local(checkpoint_dir(spark)), "contrail-*")))
    before = tables()
    scored = catalog_models.scored_test_rows(spark, SF_SMALL, {"n_estimators": 1, "max_depth": 2, "min_child_samples": 20, "seed": 42})
    kept = [t for t in (spark.read.parquet(p) for p in tables() - before) if "flight_id" in t.columns]
    assert [t.columns[-1] for t in kept] == ["split"]
    assert "l_extendedprice" not in kept[0].columns
    assert scored.count() == kept[0].filter("split = 'test'").count()
