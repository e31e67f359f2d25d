from __future__ import annotations

import pytest

from posloom.session import shared_dir
from posloom.sources import spine, text, warehouse


def test_bad_lines(spark, tmp_path):
    path = tmp_path / "feed.csv"
    path.write_text("n,name\n1,a\nx,b\n3,c,d\n")
    kept = text.read_delimited(spark, str(path), "n int, name string")
    assert {r.n for r in kept.filter(kept._corrupt_record.isNull()).collect()} == {1}
    assert kept.count() == 3
    dropped = text.read_delimited(spark, str(path), "n int, name string", bad_lines="drop")
    assert [tuple(r) for r in dropped.collect()] == [(1, "a")]
    with pytest.raises(Exception, match="(?i)malformed"):
        text.read_delimited(spark, str(path), "n int, name string", bad_lines="fail").collect()


def test_encoding_and_header(spark, tmp_path):
    path = tmp_path / "latin.csv"
    path.write_bytes("ACCT MAJOR\tn\nCafé\t1\n".encode("latin-1"))
    rows = text.read_delimited(spark, str(path), sep="\t", encoding="ISO-8859-1")
    assert rows.columns == ["ACCT MAJOR", "n"] and rows.first()[0] == "Café"


def test_records(spark, tmp_path):
    (tmp_path / "f.txt").write_text("India, 1 ,x\nAsia\n")
    found = text.read_records(spark, str(tmp_path / "f.txt"), ["a", "b"])
    assert [r.record for r in found.collect()] == [{"a": "India", "b": "1"}, {"a": "Asia"}]


class Reader:
    """Stands in for ``spark.read``: notes what would be asked of a database."""

    def __init__(self):
        self.noted = {}

    def format(self, name):
        self.noted["format"] = name
        return self

    def option(self, key, value):
        self.noted[key] = value
        return self

    def options(self, **options):
        self.noted.update(options)
        return self

    def load(self):
        return self.noted


class Session:
    @property
    def read(self):
        return Reader()


def test_warehouse_options():
    plain = warehouse.read_query(Session(), "jdbc:x", "SELECT 2 AS id", user="u")
    assert plain == {"format": "jdbc", "url": "jdbc:x", "user": "u", "query": "SELECT 2 AS id"}
    split = warehouse.read_query(Session(), "jdbc:x", "SELECT 1 AS id", "id", (1, 9), 4)
    assert split["dbtable"] == "(SELECT 1 AS id) items" and split["numPartitions"] == "4" and "query" not in split
    with pytest.raises(ValueError):
        warehouse.read_query(Session(), "jdbc:x", "SELECT 1 AS id", split_on="id")


def test_date_spine(spark):
    df = spark.createDataFrame([("2020-02-27",), ("2020-03-01",)], "d string")
    days = spine.date_spine(df, "d")
    assert [str(r.day) for r in days.collect()] == ["2020-02-27", "2020-02-28", "2020-02-29", "2020-03-01"]
    noisy = spine.with_random_value(days, 7, "day")
    assert noisy.columns == ["day", "value"]
    assert sorted(noisy.collect()) == sorted(spine.with_random_value(days.repartition(3), 7, "day").collect())
    draws = [r.value for r in spine.with_random_value(spark.range(4000), 1, "id").collect()]
    mean = sum(draws) / 4000
    assert abs(mean) < 0.06 and abs(sum((d - mean) ** 2 for d in draws) / 4000 - 1) < 0.08


def test_shared_folder_is_the_one_the_cluster_names(spark):
    class Cluster:
        conf = dict({"spark.checkpoint.dir": "hdfs://cluster/shared/", "spark.master": "yarn"})

    assert shared_dir(Cluster()) == "hdfs://cluster/shared"
    Cluster.conf = dict({"spark.master": "yarn"})
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Cluster())
    Cluster.conf = dict({"spark.master": "local-cluster[2,1,1024]"})
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Cluster())
    assert shared_dir(spark) == shared_dir(spark)


def test_line_numbers_over_many_blocks(spark, tmp_path):
    """Row numbers are line numbers however many splits read the file, blank lines and quotes included."""
    lines = ["Weekly report", "Item Nbr,Label", ""] + [f'{n},"a ""{n}"", b"' if n % 3 else f"{n},plain" for n in range(3, 4000)]
    (tmp_path / "one.csv").write_text("\ufeff" + "\r\n".join(lines) + "\r\n")
    (tmp_path / "two.csv").write_text("x\nNbr,L\n7,\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        grid = text.delimited_grid(spark, str(tmp_path))
        assert grid.rdd.getNumPartitions() >= 5
        rows = {(r.path[-7:-4], r.row_idx): r.cells for r in grid.collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    want = {("one", 0): ["Weekly report"], ("one", 1): ["Item Nbr", "Label"], ("one", 2): [None]}
    want |= {("one", n): [str(n), f'a "{n}", b' if n % 3 else "plain"] for n in range(3, 4000)}
    want |= {("two", 0): ["x"], ("two", 1): ["Nbr", "L"], ("two", 2): ["7", None]}
    assert rows == want


def test_bad_lines_are_dropped_whatever_is_asked_for(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b\n1,2\n3,x\n5,6\n")
    read = text.read_delimited(spark, str(tmp_path), "a int, b int", bad_lines="drop")
    assert sorted(r.a for r in read.select("a").collect()) == [1, 5] and read.count() == 2
