"""Update and delete that change a table: only touched files, one version a change."""

import os

import pytest
from pyspark.sql import functions as F

from quayside.sinks.tables import ParquetTable
from quayside.sinks.versions import Conflict, FileTable


@pytest.fixture()
def table(spark, scratch):
    rows = spark.range(100).select("id", (F.col("id") * 10).alias("v"), F.when(F.col("id") == 50, F.lit(None)).otherwise(F.concat(F.lit("n"), F.col("id"))).alias("name"))
    return ParquetTable.create(rows.repartitionByRange(5, "id"), os.path.join(scratch, "t"))


def files(t, version=None):
    return {r.path for r in t.log.files(version).collect()}


def test_an_update_of_one_key_rewrites_one_file(spark, table):
    before = files(table)
    assert len(before) == 5
    assert table.update(spark.createDataFrame([(7, -1), (7000, -2)], "id bigint, v bigint"), "id") == 1
    after = files(table)
    assert len(before - after) == 1 == len(after - before)
    got = {r.id: r.v for r in table.read().collect()}
    assert got == {i: i * 10 for i in range(100)} | {7: -1}
    assert {r.id: r.v for r in table.read(1).collect()}[7] == 70


def test_updates_with_an_order_and_nulls(spark, table):
    u = spark.createDataFrame([(3, 1, None, 1), (3, 2, "x", 2), (50, None, "was null", 1), (51, None, None, 1)], "id bigint, v bigint, name string, step int")
    u = u.withColumn("nulls", F.when(F.col("id") == 51, F.array(F.lit("name"))))
    assert table.update(u, "id", order="step", set_null="nulls") == 3
    got = {r.id: (r.v, r.name) for r in table.read().filter("id IN (3, 50, 51)").collect()}
    assert got == {3: (2, "x"), 50: (500, "was null"), 51: (510, None)}
    with pytest.raises(Exception, match="two updates of key"):
        table.update(u, "id")


def test_delete_and_insert(spark, table):
    before = files(table)
    assert table.delete_by_key("id", 99) == 1 and table.delete_by_key("id", 99) == 0
    assert len(before - files(table)) == 1 and table.log.latest() == 2
    assert table.delete(F.col("name") == "n50") == 0          # a null condition deletes nothing
    assert table.delete(F.col("id") < 20) == 20               # whole files go
    assert table.insert(spark.createDataFrame([(1000, "new", 1)], "id bigint, name string, v bigint")) == 1
    assert sorted(r.id for r in table.read().collect()) == [*range(20, 99), 1000]
    assert table.delete(F.lit(True)) == 80 and table.read().count() == 0
    assert table.read(1).count() == 100


def test_a_change_that_meets_another_is_made_again(spark, table, monkeypatch):
    other, original, once = ParquetTable(spark, table.path), FileTable.publish, []

    def slow(self, adds=None, removes=None, note=""):
        if self is table.log and not once:
            once.append(other.update(spark.createDataFrame([(8, -8)], "id bigint, v bigint"), "id"))
        return original(self, adds, removes, note)

    monkeypatch.setattr(FileTable, "publish", slow)
    assert table.update(spark.createDataFrame([(7, -7)], "id bigint, v bigint"), "id") == 1
    got = {r.id: r.v for r in table.read().collect()}
    assert (got[7], got[8], len(got)) == (-7, -8, 100)
    monkeypatch.setattr(FileTable, "publish", lambda *a, **k: (_ for _ in ()).throw(Conflict("always")))
    with pytest.raises(Conflict):
        table.delete_by_key("id", 1)


def test_one_table_a_folder(spark, table):
    with pytest.raises(ValueError):
        ParquetTable.create(table.read(), table.path)
