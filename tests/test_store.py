"""Versions of stored arrays."""

import pytest
from pyspark.sql import functions as F

from slabwise import ArrayError, ArraySchema, Attr, Dim
from slabwise.sources import array_versions, open_array, store_array, vacuum_array
from slabwise.sources import store
from slabwise.sources.files import write_new


def described(n):
    return ArraySchema("a", (Attr("v", "int64"),), (Dim("d0", n, 10),))


def cells(spark, n, add=0):
    return spark.range(n).select(F.col("id").alias("d0"), (F.col("id") + add).alias("v"))


def total(spark, path, version=None):
    return open_array(spark, path, version)[0].agg(F.count("*"), F.sum("v")).first()[:]


def test_a_write_that_dies_leaves_the_array_as_it_was(spark, tmp_path):
    path = str(tmp_path / "a")
    store_array(cells(spark, 100), path, described(100))
    reader, _ = open_array(spark, path)
    broken = cells(spark, 1000, 7).withColumn("v", F.when(F.col("d0") == 900, F.raise_error(F.lit("lost"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="lost"):
        store_array(broken.repartition(8), path, described(1000), mode="overwrite")
    assert total(spark, path) == (100, 4950) and [s.version for s in array_versions(path)] == [1]
    store_array(cells(spark, 50), path, described(50), mode="overwrite")
    # A reader keeps the snapshot it has opened.
    assert reader.count() == 100 and total(spark, path) == (50, 1225)
    assert open_array(spark, path)[1].shape == (50,)


def test_an_array_can_be_replaced_by_its_own_rows(spark, tmp_path):
    path = str(tmp_path / "a")
    store_array(cells(spark, 10), path, described(10))
    store_array(open_array(spark, path)[0].where("d0 < 5"), path, described(5), mode="overwrite")
    assert total(spark, path) == (5, 10)


def test_modes_versions_and_vacuum(spark, tmp_path):
    path = str(tmp_path / "a")
    store_array(cells(spark, 10), path, described(10))
    with pytest.raises(ArrayError, match="there is an array already, version 1"):
        store_array(cells(spark, 5), path, described(5))
    assert store_array(cells(spark, 5), path, described(5), mode="ignore").version == 1
    store_array(cells(spark, 20).where("d0 >= 10"), path, described(20), mode="append")
    with pytest.raises(ArrayError, match="the array there is"):
        store_array(cells(spark, 5), path, described(5).with_chunks((3,)), mode="append")
    with pytest.raises(ArrayError, match="unknown mode"):
        store_array(cells(spark, 5), path, described(5), mode="replace")
    store_array(cells(spark, 3, 1), path, described(3), mode="overwrite")
    assert [total(spark, path, v) for v in (1, 2, 3)] == [(10, 45), (20, 190), (3, 6)]
    with pytest.raises(ArrayError, match="no version 9"):
        open_array(spark, path, 9)
    assert vacuum_array(path, keep=2) == []  # version 2 still needs the folder of version 1
    assert [s.version for s in array_versions(path)] == [2, 3] and total(spark, path, 2) == (20, 190)
    assert len(vacuum_array(path)) == 2 and total(spark, path) == (3, 6)
    with pytest.raises(ArrayError):
        vacuum_array(path, keep=0)


def test_of_two_writers_one_fails(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "a")
    store_array(cells(spark, 10), path, described(10))

    def late(manifest, data):
        monkeypatch.setattr(store, "write_new", write_new)
        store_array(cells(spark, 20), path, described(20), mode="overwrite")  # the other writer is first
        write_new(manifest, data)

    monkeypatch.setattr(store, "write_new", late)
    with pytest.raises(ArrayError, match="another writer made version 2"):
        store_array(cells(spark, 30), path, described(30), mode="overwrite")
    assert total(spark, path) == (20, 190)


def test_plain_folders_are_arrays_too(spark, tmp_path):
    path = str(tmp_path / "plain")
    described(10).attach(cells(spark, 10)).write.parquet(path)
    assert total(spark, path) == (10, 45) and open_array(spark, path)[1] == described(10)
