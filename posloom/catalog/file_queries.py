"""Tables written out and read back, in batch and as streams.

They write to the shared folder (see ``session.shared_dir``) and return what
the written tables hold.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from posloom.catalog import views as v
from posloom.catalog.operator_queries import OUTCOMES, WEEK, outcomes
from posloom.catalog.registry import register
from posloom.functions import conditions as cond
from posloom.plans.publish import Sinks, publish, read_ledger, read_published, stage_outcomes, unstage
from posloom.session import shared_dir
from posloom.sources import grid as g
from posloom.sources import text as text_files
from posloom.streaming import guard, weekly


def scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@register(
    "csv_round_trip",
    "SELECT c_custkey, c_name, c_acctbal, c_mktsegment, c_custkey % 10 = 3 AS bad FROM customer",
)
def _(spark, sf_dir):
    """Every tenth line is written with a word for its number and is kept as unreadable."""
    path = scratch(spark, "customer-csv")
    columns = ["c_custkey", "c_name", "c_acctbal", "c_mktsegment"]
    table = v.table(spark, sf_dir, "customer").select(*columns)
    balance = F.when(F.col("c_custkey") % 10 == 3, F.concat(F.lit("about "), "c_acctbal")).otherwise(F.col("c_acctbal").cast("string"))
    table.withColumn("c_acctbal", balance).write.option("header", True).option("encoding", "ISO-8859-1").csv(path)
    schema = "c_custkey bigint, c_name string, c_acctbal double, c_mktsegment string"
    read = text_files.read_delimited(spark, path, schema, encoding="ISO-8859-1", bad_lines="keep")
    bad = F.col(text_files.CORRUPT).isNotNull()
    said = F.try_element_at(F.split(text_files.CORRUPT, ",", -1), F.lit(3))
    mended = F.when(bad, F.regexp_replace(said, "about ", "").cast("double")).otherwise(F.col("c_acctbal"))
    return read.select("c_custkey", "c_name", mended.alias("c_acctbal"), "c_mktsegment", bad.alias("bad"))


@register("csv_bad_lines_dropped", "SELECT c_custkey, c_name FROM customer WHERE c_custkey % 10 <> 3")
def _(spark, sf_dir):
    path = scratch(spark, "customer-bad-csv")
    balance = F.when(F.col("c_custkey") % 10 == 3, "?").otherwise(F.col("c_acctbal").cast("string"))
    v.table(spark, sf_dir, "customer").select("c_custkey", "c_name", balance.alias("c_acctbal")).write.option("header", True).csv(path)
    read = text_files.read_delimited(spark, path, "c_custkey bigint, c_name string, c_acctbal double", bad_lines="drop")
    return read.select("c_custkey", "c_name")


@register(
    "split_text_sheet",
    "SELECT c_nationkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS row_idx, "
    "CAST(c_custkey AS VARCHAR) AS nbr, c_name || ', \"' || c_mktsegment || '\"' AS label FROM customer",
)
def _(spark, sf_dir):
    """One export per nation, read in splits; line numbers as in the file, quoted cells."""
    path = scratch(spark, "customer-sheets")
    label = F.format_string('%s, "%s"', "c_name", "c_mktsegment")
    rows = v.table(spark, sf_dir, "customer").select("c_nationkey", F.col("c_custkey").alias("Item Nbr"), label.alias("Label"))
    sorted_rows = rows.repartition("c_nationkey").sortWithinPartitions("c_nationkey", "Item Nbr")
    sorted_rows.write.partitionBy("c_nationkey").option("header", True).option("escape", '"').csv(path)
    grid = text_files.delimited_grid(spark, path)
    nation = F.regexp_extract("path", "c_nationkey=(\\d+)", 1).cast("int")
    named = g.named_rows(grid, 0)
    return named.select(nation.alias("c_nationkey"), "row_idx", g.cell("Item Nbr").alias("nbr"), g.cell("Label").alias("label"))


@register(
    "text_records",
    "SELECT c_name AS name, c_mktsegment AS segment FROM customer",
)
def _(spark, sf_dir):
    path = scratch(spark, "customer-lines")
    v.table(spark, sf_dir, "customer").selectExpr(
        "concat(c_name, ' , ', c_mktsegment, ',', c_custkey) AS value"
    ).write.text(path)
    records = text_files.read_records(spark, path, ["name", "segment"])
    return records.select(
        *[F.try_element_at("record", F.lit(k)).alias(k) for k in ("name", "segment")]
    )


def held_back(rows: DataFrame, *held: str) -> DataFrame:
    """Outcome rows of all accounts; only those of ``held`` keep their exceptions."""
    return rows.filter((F.col("outcome") != "exception") | F.col("account").isin(*held))


def published_rows(spark: SparkSession, sf_dir: str, *held: str) -> DataFrame:
    """Outcome rows of all accounts as they are published; only those of ``held`` keep their exceptions."""
    rows = outcomes(spark, sf_dir)
    failed = F.col("outcome") == "exception"
    return held_back(rows, *held).select(
        "src_file",
        "src_sheet",
        "src_row",
        F.upper("account").alias("AccountMajor"),
        F.col("account").alias("Account"),
        cond.clicks_when(F.col("channel"), "ONLINE").alias("BricksClicks"),
        F.col("cust_item").alias("CustItemNumber"),
        F.lit("").alias("CustItemDesc"),
        F.col("stock_no").alias("CustVendStkNo"),
        F.lit("").alias("ItemID"),
        "ItemNumber",
        "MainlinePremium",
        "POSAmount",
        "POSQuantity",
        F.col("upc").alias("UPC"),
        F.lit(WEEK).alias("WeekEnding"),
        F.when(failed, "exception").otherwise("final").alias("outcome"),
        F.lit(None).cast("string").alias("reason"),
        F.lit(1).alias("match_pass"),
        F.lit(1).alias("counted"),
    )


def _sink_sql(held: str) -> str:
    """What the four sinks hold if only ``held`` has exceptions."""
    select = "SELECT '{0}' AS sink, account, '2020-02-22' AS week, count(*) AS n, CAST(sum(POSAmount) AS DOUBLE) AS amount"
    clean = f" FROM outcomes WHERE outcome = 'final' AND account <> '{held}' GROUP BY ALL"
    parts = [select.format(sink) + clean for sink in ("tsv", "archive", "validation")]
    parts.append(select.format("exceptions") + f" FROM outcomes WHERE outcome = 'exception' AND account = '{held}' GROUP BY ALL")
    return OUTCOMES + " UNION ALL ".join(parts)


def _sinks_read_back(spark: SparkSession, sinks: Sinks) -> DataFrame:
    def totals(shown: str, sink: str, n) -> DataFrame:
        amount = F.col("POSAmount").cast("decimal(28,4)")
        return read_published(spark, sinks, sink).groupBy(
            F.lit(shown).alias("sink"),
            F.col("for_account").alias("account"),
            F.col("for_week").alias("week"),
        ).agg(n, F.sum(amount).alias("amount"))

    written = F.count(F.lit(1)).alias("n")
    counted = F.sum(F.col("row_count").cast("bigint")).alias("n")
    return (
        totals("tsv", "tsv", written)
        .unionByName(totals("archive", "archive_csv", written))
        .unionByName(totals("exceptions", "exceptions", written))
        .unionByName(totals("validation", "validation", counted))
    )


@register("publish_round_trip", _sink_sql("sears"))
def _(spark, sf_dir):
    sinks = Sinks.under(scratch(spark, "published"))
    publish(spark, published_rows(spark, sf_dir, "sears"), sinks)
    return _sinks_read_back(spark, sinks)


@register("publish_replaces", _sink_sql("amazon"))
def _(spark, sf_dir):
    """Published twice: one account's exceptions are mended, another's come up."""
    sinks = Sinks.under(scratch(spark, "republished"))
    rows = stage_outcomes(spark, published_rows(spark, sf_dir, "sears", "amazon"))  # matched and staged once for both
    publish(spark, held_back(rows, "sears"), sinks, staged=True)
    publish(spark, held_back(rows, "amazon"), sinks, staged=True)
    unstage(spark, rows)
    return _sinks_read_back(spark, sinks)


@register(
    "publish_ledger",
    "SELECT DISTINCT 'part ' || (l_orderkey % 997) AS path, a AS account FROM lineitem, "
    "(VALUES ('amazon'), ('sears'), ('target')) t(a) WHERE NOT (a = 'sears' AND l_orderkey % 997 IN "
    + "(SELECT l_orderkey % 997 FROM (" + OUTCOMES + "SELECT src_row // 10 AS l_orderkey FROM outcomes "
    "WHERE account = 'sears' AND outcome = 'exception')))",
)
def _(spark, sf_dir):
    """Nearly a thousand files of each of three accounts; those of one account with exceptions come up again."""
    sinks = Sinks.under(scratch(spark, "noted"))
    number = F.floor(F.col("src_row") / 10)
    rows = published_rows(spark, sf_dir, "sears").withColumn("src_file", F.concat(F.lit("part "), (number % 997).cast("string")))
    parts = v.table(spark, sf_dir, "lineitem").select(F.concat(F.lit("part "), (F.col("l_orderkey") % 997).cast("string")).alias("path")).distinct()
    names = F.array(*[F.struct(F.lit(n).alias("account"), F.lit(n.upper()).alias("major")) for n in ("amazon", "sears", "target")])
    publish(spark, rows, sinks, parts.select("path", F.inline(names)))
    return read_ledger(spark, sinks.commits)


def newest_first(spark: SparkSession, path: str, schema) -> DataFrame:
    """A stream of a folder's files or of one file, one file a batch, newest first."""
    one = f"{path[:-1]}[{path[-1]}]"  # a pattern may name a file or a folder of files
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", 1)
        .option("latestFirst", True)
        .parquet(one)
    )


def _event_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """All events, rewritten as files by time, the latest events in the first batch."""
    events = v.table(spark, sf_dir, "events").select(
        F.col("ts").cast("timestamp").alias("ts"),
        "event_type",
        "user_id",
        F.col("value").cast("decimal(18,2)").alias("amount"),
    )
    source = scratch(spark, f"{name}-in")
    events.repartitionByRange(4, F.desc("ts")).write.parquet(source)
    return newest_first(spark, source, events.schema)


@register(
    "weekly_control_stream",
    "SELECT strftime(date_trunc('week', ts)::DATE + 5, '%Y-%m-%d') AS week_ending, event_type, "
    "CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS amount, count(*) AS row_count FROM events GROUP BY ALL",
)
def _(spark, sf_dir):
    base = scratch(spark, "weekly")
    totals = weekly.weekly_totals(_event_stream(spark, sf_dir, "weekly"), "ts", "event_type", "amount")
    weekly.keep_latest(totals, f"{base}/table", f"{base}/checkpoint").awaitTermination()
    return weekly.latest(spark, f"{base}/table", ["week_ending", "event_type"])


@register(
    "weekly_control_batch",
    "SELECT strftime(date_trunc('week', ts)::DATE + 5, '%Y-%m-%d') AS week_ending, event_type, "
    "CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS amount, count(*) AS row_count FROM events GROUP BY ALL",
)
def _(spark, sf_dir):
    events = v.table(spark, sf_dir, "events").select(
        F.col("ts").cast("timestamp").alias("ts"), "event_type", F.col("value").cast("decimal(18,2)").alias("amount")
    )
    return weekly.weekly_totals(events, "ts", "event_type", "amount")


@register("run_guard_stream", "SELECT DISTINCT event_type, user_id FROM events")
def _(spark, sf_dir):
    base = scratch(spark, "guard")
    runs = _event_stream(spark, sf_dir, "guard").select("event_type", "user_id")
    guard.keep_first_runs(runs, ["event_type", "user_id"], f"{base}/table", f"{base}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{base}/table").drop("batch")
