from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from books import write_book
from posloom.catalog.file_queries import newest_first
from posloom.sources import commits as log
from posloom.streaming import guard, ingest, weekly


def test_each_workbook_is_read_once_and_archived(spark, tmp_path):
    raw, table, checkpoint = tmp_path / "raw", tmp_path / "grid", str(tmp_path / "checkpoint")
    raw.mkdir()

    def load():
        grid = ingest.workbook_stream(spark, str(raw), str(tmp_path / "archive"))
        ingest.ingest_available(grid, str(table), checkpoint).awaitTermination()
        return sorted(r.cells[0] for r in spark.read.parquet(str(table)).collect())

    write_book(raw / "a.xlsx", {"S": [["a1"], ["a2"]]})
    assert load() == ["a1", "a2"]
    write_book(raw / "b.xlsx", {"S": [["b1"]]})
    assert load() == ["a1", "a2", "b1"]
    assert load() == ["a1", "a2", "b1"]
    assert any((tmp_path / "archive").rglob("a.xlsx"))


EVENTS = "ts timestamp, account string, amount decimal(18,2)"


def write_events(spark, path, rows):
    rows = [(ts, account, Decimal(amount)) for ts, account, amount in rows]
    spark.createDataFrame(rows, EVENTS).coalesce(1).write.mode("append").parquet(str(path))


def test_weekly_totals_grow_with_new_files(spark, tmp_path):
    source, table, checkpoint = tmp_path / "in", tmp_path / "table", str(tmp_path / "checkpoint")

    def load():
        stream = spark.readStream.schema(EVENTS).parquet(str(source))
        totals = weekly.weekly_totals(stream, "ts", "account", "amount")
        weekly.keep_latest(totals, str(table), checkpoint).awaitTermination()
        found = weekly.latest(spark, str(table), ["week_ending", "account"]).collect()
        return sorted((str(r.week_ending), r.account, float(r.amount), r.row_count) for r in found)

    # Monday 2020-02-17 to Sunday 2020-02-23 is the week of Saturday 2020-02-22.
    write_events(spark, source, [
        (dt.datetime(2020, 2, 17, 0, 0), "a", 1), (dt.datetime(2020, 2, 23, 23, 59), "a", 2),
        (dt.datetime(2020, 2, 24, 0, 0), "a", 4),
    ])
    assert load() == [("2020-02-22", "a", 3.0, 2), ("2020-02-29", "a", 4.0, 1)]
    write_events(spark, source, [(dt.datetime(2020, 2, 25, 0, 0), "a", 8), (dt.datetime(2020, 2, 25, 0, 0), "b", 1)])
    assert load() == [("2020-02-22", "a", 3.0, 2), ("2020-02-29", "a", 12.0, 2), ("2020-02-29", "b", 1.0, 1)]
    batch = weekly.weekly_totals(spark.read.parquet(str(source)), "ts", "account", "amount")
    assert sorted((str(r.week_ending), r.account, float(r.amount), r.row_count) for r in batch.collect()) == load()


def test_late_files_count_and_compaction_changes_nothing(spark, tmp_path):
    """Four files, newest first, one a batch: no sale is too late."""
    source, table, checkpoint = tmp_path / "in", tmp_path / "table", str(tmp_path / "checkpoint")
    keys = ["week_ending", "account"]

    def load():
        stream = newest_first(spark, str(source), EVENTS)
        weekly.keep_latest(weekly.weekly_totals(stream, "ts", "account", "amount"), str(table), checkpoint).awaitTermination()
        return totals()

    def totals():
        return sorted((str(r.week_ending), r.account, r.row_count) for r in weekly.latest(spark, str(table), keys).collect())

    for month in (12, 9, 6, 1):
        write_events(spark, source, [(dt.datetime(2020, month, 7), "a", 1), (dt.datetime(2020, 1, 7), "a", 1)])
    want = [("2020-01-11", "a", 5), ("2020-06-06", "a", 1), ("2020-09-12", "a", 1), ("2020-12-12", "a", 1)]
    assert load() == want
    weekly.compact(spark, str(table), keys)
    assert len(weekly.snapshot(spark, str(table))[0]) == 1 and totals() == want
    write_events(spark, source, [(dt.datetime(2020, 1, 8), "a", 1)])
    assert load() == [("2020-01-11", "a", 6), *want[1:]]


def test_run_guard_lets_a_run_through_once(spark, tmp_path):
    source, table, checkpoint = tmp_path / "in", tmp_path / "table", str(tmp_path / "checkpoint")

    def load():
        stream = newest_first(spark, str(source), EVENTS).select("account", F.to_date("ts").alias("week"))
        guard.keep_first_runs(stream, ["account", "week"], str(table), checkpoint).awaitTermination()
        return sorted((str(r.account), str(r.week)) for r in spark.read.parquet(str(table)).collect())

    day, other = dt.datetime(2020, 2, 22, 1, 0), dt.datetime(2020, 12, 1)
    write_events(spark, source, [(day, "a", 1), (day, "a", 2), (day, None, 2)])
    assert load() == [("None", "2020-02-22"), ("a", "2020-02-22")]
    write_events(spark, source, [(other, "a", 3)])
    write_events(spark, source, [(day, "a", 3), (day, "b", 3), (day, None, 1)])
    assert load() == [("None", "2020-02-22"), ("a", "2020-02-22"), ("a", "2020-12-01"), ("b", "2020-02-22")]


def batches(spark, table, rows):
    """Requests as one-batch streams into the same table, one after the other."""
    source, checkpoint = table.parent / "requests", str(table.parent / "requests-checkpoint")
    for batch in rows:
        spark.createDataFrame([(k,) for k in batch], "k string").coalesce(1).write.mode("append").parquet(str(source))
        stream = spark.readStream.schema("k string").parquet(str(source))
        guard.keep_first_runs(stream, ["k"], str(table), checkpoint).awaitTermination()


def test_a_batch_reads_its_own_hash_folders_only(spark, tmp_path, monkeypatch):
    """Fifty batches of three new keys and a repeat: what one reads does not grow with the history."""
    table, schema = tmp_path / "table", spark.createDataFrame([], "k string").schema
    monkeypatch.setattr(guard, "PARTS", 64)
    guard.prepare_store(spark, str(table), ["k"], schema)
    read, kept = [], []
    for n in range(50):
        keys = [f"run {n} {i}" for i in range(3)] + [f"run {n // 2} 0"]
        batch = spark.createDataFrame([(k,) for k in keys], "k string").coalesce(1)
        folder, parts = guard.layout(spark, str(table))
        touched = sorted(r[0] for r in batch.select(guard._part(["k"], parts)).distinct().collect())
        paths = guard.folders_to_read(spark, folder, touched, n)
        read.append(sum(f.stat().st_size for p in paths for f in __import__("pathlib").Path(p).glob("*.parquet")))
        seen = spark.read.schema(schema).parquet(*paths) if paths else None
        new = guard.first_runs(batch, ["k"], seen)
        kept += [r.k for r in new.collect()]
        guard._put(new, folder, ["k"], parts, n)
        if n % 10 == 9:
            guard.compact_keys(spark, str(table), ["k"], part_keys=1)
    assert sorted(kept) == sorted({f"run {n} {i}" for n in range(50) for i in range(3)})
    whole = sum(f.stat().st_size for f in table.rglob("part=*/**/*.parquet"))
    assert max(read[40:]) <= 2 * max(read[5:15]) and max(read[40:]) < whole / 8
    assert guard.layout(spark, str(table))[1] >= 128


def test_guard_lets_each_key_through_once_over_compactions(spark, tmp_path):
    table = tmp_path / "table"
    batches(spark, table, [["a", "b", "b"], ["b", "c"]])
    guard.compact_keys(spark, str(table), ["k"], part_keys=1)
    batches(spark, table, [["a", "c", "d", None], [None, "d", "e"]])
    rows = spark.read.parquet(str(table)).collect()
    assert sorted(str(r.k) for r in rows) == ["None", "a", "b", "c", "d", "e"]


def test_a_batch_run_again_finds_no_key_of_its_own(spark, tmp_path):
    table = tmp_path / "table"
    batches(spark, table, [["a"], ["b", "c"]])
    last = sorted((table.parent / "requests-checkpoint" / "commits").glob("[0-9]*"))[-1]
    for stale in (last, last.with_name(f".{last.name}.crc")):
        stale.unlink()  # as if the run had stopped before the batch was noted as done
    guard.compact_keys(spark, str(table), ["k"])
    batches(spark, table, [["a", "c", "d"]])
    assert sorted(r.k for r in spark.read.parquet(str(table)).collect()) == ["a", "b", "c", "d"]


def test_a_table_without_key_store_gets_one(spark, tmp_path):
    table = tmp_path / "table"
    spark.createDataFrame([("a",), ("b",)], "k string").write.parquet(str(table / "batch=0"))
    guard.prepare_store(spark, str(table), ["k"], spark.createDataFrame([], "k string").schema)
    folder, parts = guard.layout(spark, str(table))
    assert sorted(r.k for r in spark.read.parquet(folder).collect()) == ["a", "b"]


def test_compaction_beside_readers_and_batches(spark, tmp_path):
    """A reader's snapshot stays readable over a compaction, and a batch committed meanwhile is not lost."""
    table, keys = str(tmp_path / "table"), ["account"]

    def batch(number, rows):
        folder = f"batch-{number}-x{len(log.names_in(spark, table))}"
        frame = spark.createDataFrame(rows, "account string, amount bigint").withColumn("_batch", F.lit(number))
        frame.coalesce(1).write.parquet(f"{table}/{folder}")
        log.commit(spark, f"{table}/_batches", {"folder": folder, "batch": number})

    def totals(frame):
        return sorted(tuple(r) for r in frame.select("account", "amount").collect())

    batch(0, [("a", 1), ("b", 1)])
    batch(1, [("a", 3)])
    batch(1, [("a", 2)])  # run again
    reader = weekly.latest(spark, table, keys)
    folders, upto = weekly.snapshot(spark, table)
    merged = weekly._current(spark, table, folders, keys)
    batch(2, [("c", 7)])  # committed while the compaction runs
    merged.write.parquet(f"{table}/merged-1-y")
    log.commit(spark, f"{table}/_merges", {"folder": "merged-1-y", "batch": upto, "replaced": folders})
    assert totals(reader) == [("a", 2), ("b", 1)]
    assert totals(weekly.latest(spark, table, keys)) == [("a", 2), ("b", 1), ("c", 7)]
    weekly.compact(spark, table, keys)
    assert totals(weekly.latest(spark, table, keys)) == [("a", 2), ("b", 1), ("c", 7)]
    assert not set(folders) & set(log.names_in(spark, table)) and len(weekly.snapshot(spark, table)[0]) == 1
