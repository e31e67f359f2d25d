"""The matching rewrites against plain pandas merges on random frames."""

from __future__ import annotations

import random
from decimal import Decimal

import pandas as pd
import pytest
from pyspark.sql import functions as F

from posloom.plans.accounts import ACCOUNTS, LEGACY_ACCOUNTS
from posloom.plans.engine import lay_out, match_reference, match_strict
from posloom.plans.master import measured
from posloom.plans.publish import gate
from posloom.session import BROADCAST_LIMIT_KEY

SPECS = {**ACCOUNTS, **LEGACY_ACCOUNTS}
TEXT = [
    "CustItemNumber", "CustItemDesc", "CustVendStkNo", "Account", "Channel", "BricksClicks",
    "UPC", "ShortUpc", "Group", "Store", "Concept", "Format",
]
MONEY = ["AvgRetail", "SalesLastYear", "SalesChange", "POSAmount"]
MASTER = [
    "item_number", "upc12", "short_upc", "brand", "short_brand", "amazon_id", "depot_id", "kmart_id",
    "meijer_id", "target_id", "walmart_id", "sears_id", "vendor_item", "description",
]


def random_frames(seed: int, rows: int = 60, items: int = 12, heavy: bool = False):
    rng = random.Random(seed)
    keys = ["k1", "k2", "k3", "k4", "k5", None]
    feed = []
    for i in range(rows):
        row = {"src_file": rng.choice(["a", "b"]), "src_sheet": 0, "src_row": i}
        for c in TEXT:
            few = c in ("CustItemDesc", "Account", "Channel", "Group", "Store", "Concept", "Format", "BricksClicks")
            row[c] = rng.choice(["x", "y"] if few else (["k1", "k1", "k1", *keys] if heavy else keys))
        for c in MONEY:
            row[c] = rng.choice([0.5, 1.0, -1.0, None])
        row["POSQuantity"] = rng.choice([1, 2])
        feed.append(row)
    master = []
    for i in range(items):
        row = {c: rng.choice(keys) for c in MASTER}
        row["short_brand"] = rng.choice(["QUINNY", "Other", None])
        row["brand"] = rng.choice(["b", None])
        row["master_row"] = i
        master.append(row)
    feed.sort(key=lambda r: (r["src_file"], r["src_row"]))
    return pd.DataFrame(feed).astype(object), pd.DataFrame(master).astype(object)


def to_spark(spark, feed, master):
    def clean(value):
        return None if value is None or value != value else value

    feed_rows = [
        tuple(
            Decimal(str(v)) if c in MONEY and clean(v) is not None else clean(v)
            for c, v in zip(feed.columns, row)
        )
        for row in feed.itertuples(index=False)
    ]
    kinds = {**{c: "string" for c in TEXT}, **{c: "decimal(18,4)" for c in MONEY}}
    kinds |= {"src_file": "string", "src_sheet": "int", "src_row": "bigint", "POSQuantity": "int"}
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in feed.columns)
    master_schema = ", ".join(f"{c} {'bigint' if c == 'master_row' else 'string'}" for c in master.columns)
    master_rows = [tuple(clean(v) for v in row) for row in master.itertuples(index=False)]
    return (
        spark.createDataFrame(feed_rows, schema).repartition(4),
        measured(spark.createDataFrame(master_rows, master_schema).repartition(3)),
    )


def merged(feed, master, step):
    keyless = master[master[step.master_key].isna()].sort_values("master_row").head(1)
    items = pd.concat([master[master[step.master_key].notna()], keyless]).sort_values("master_row")
    items = items.rename(columns=lambda c: f"m_{c}")
    return feed.merge(items, how="left", left_on=step.feed_key, right_on=f"m_{step.master_key}")


def tier(short_brand):
    return "Premium" if short_brand == "QUINNY" else "Mainline"


def outcome_rows(frame, step, number, item=None, blanks=()):
    """(row, item, brand, pass, outcome) of merged rows by the flag of a pass."""
    result = []
    for row in frame.to_dict("records"):
        hit = pd.notna(row[f"m_{step.flag}"])
        result.append(
            (
                row["src_row"],
                (item(row) if item else row["m_item_number"]) if hit else None,
                tier(row["m_short_brand"]) if hit else None,
                number if hit else None,
                "final" if hit else "exception",
                None if hit and "CustItemNumber" in blanks else row["CustItemNumber"],
            )
        )
    return result


def brute_force(spec, feed, master):
    first = spec.passes[0]
    joined = merged(feed, master, first)
    keys = [c.replace("m1.", "m_") for c in spec.dedup_keys]
    changed = {
        "always": True,
        "rows": len(joined) != len(feed),
        "amount": joined["POSAmount"].sum() != feed["POSAmount"].sum(),
    }.get(spec.dedup, False)
    if changed:
        joined = joined.drop_duplicates(subset=keys, keep="first")
    hit = joined[f"m_{first.flag}"].notna()
    done, left = joined[hit], joined[~hit]
    if spec.dedup == "final":
        done = done.drop_duplicates(subset=keys, keep="first")
    none_item = (lambda row: None) if spec.appends_unmatched else None
    result = outcome_rows(done, first, 1, none_item)
    if len(spec.passes) == 1:
        return result + outcome_rows(left, first, 1)
    second = spec.passes[1]
    retried = merged(left[feed.columns], master, second)
    again = outcome_rows(retried, second, 2, blanks=spec.second_pass_blanks)
    result += again
    if spec.appends_unmatched:
        for row in retried[retried[f"m_{second.flag}"].isna()].to_dict("records"):
            result.append(
                (row["src_row"], row["m_item_number"], tier(row["m_short_brand"]), None, "final", row["CustItemNumber"])
            )
    return result


def normal(rows):
    return sorted(
        (tuple("" if v is None or v != v else str(v) for v in row) for row in rows),
    )


def spark_rows(matched):
    is_final = F.col("outcome") == "final"
    picked = matched.select(
        "src_row",
        F.when(is_final, F.col("item_number")),
        F.when(is_final, F.col("tier")),
        "match_pass",
        "outcome",
        "CustItemNumber",
    )
    return normal(tuple(r) for r in picked.collect())


def ordered(spec, feed):
    """Where a feed is grouped first, its row order is that of the group keys."""
    if not spec.dedup_order:
        return feed
    keys = list(spec.dedup_order)
    feed = feed.dropna(subset=keys).drop_duplicates(subset=keys)
    return feed.sort_values(keys)


@pytest.mark.parametrize("name", list(SPECS))
@pytest.mark.parametrize("seed", [1, 2])
def test_reference_mode_equals_plain_merges(spark, name, seed):
    spec = SPECS[name]
    feed, master = random_frames(seed)
    feed = ordered(spec, feed)
    spark_feed, spark_master = to_spark(spark, feed, master)
    assert spark_rows(match_reference(spec, spark_feed, spark_master)) == normal(brute_force(spec, feed, master))


@pytest.mark.parametrize("name", ["bbb", "depot", "amazon"])
def test_unfired_duplicate_rule_keeps_every_copy(spark, name):
    """Copies netting to zero leave the amount total as it was."""
    spec = SPECS[name]
    step = spec.passes[0]
    feed, master = random_frames(3, rows=4, items=2)
    feed[step.feed_key] = ["k1", "k1", "k2", "k9"]
    feed["POSAmount"] = [1.0, -1.0, 0.5, 0.5]
    master[step.master_key] = "k1"
    feed = ordered(spec, feed) if spec.dedup_order else feed
    expected = brute_force(spec, feed, master)
    spark_feed, spark_master = to_spark(spark, feed, master)
    assert spark_rows(match_reference(spec, spark_feed, spark_master)) == normal(expected)


def expected_strict(spec, feed, master):
    """First master row per key, key by key, with no table operation at all."""
    result = []
    items = master.to_dict("records")
    for row in feed.to_dict("records"):
        answer = (row["src_row"], None, None, None, "exception", row["CustItemNumber"])
        for number, step in enumerate(spec.passes, 1):
            key = row[step.feed_key]
            hits = [m for m in items if key is not None and key == key and m[step.master_key] == key]
            if spec.prefer_flagged:
                hits.sort(key=lambda m: (m[step.flag] is None, m["master_row"]))
            if hits and hits[0][step.flag] is not None:
                found = hits[0]
                answer = (
                    row["src_row"], found["item_number"], tier(found["short_brand"]), number, "final", row["CustItemNumber"],
                )
                break
        result.append(answer)
    return result


@pytest.mark.parametrize("name", list(SPECS))
def test_strict_mode_gives_each_row_one_outcome(spark, name):
    spec = SPECS[name]
    feed, master = random_frames(7, heavy=True)
    spark_feed, spark_master = to_spark(spark, feed, master)
    matched = match_strict(spec, spark_feed, spark_master)
    rows = spark_rows(matched)
    assert rows == normal(expected_strict(spec, feed, master))
    assert len({r[0] for r in rows}) == len(rows) == len(feed)


@pytest.mark.parametrize("name", ["amazon", "sears", "target"])
def test_masters_beyond_the_broadcast_limit_give_the_same(spark, name):
    spec = SPECS[name]
    feed, master = random_frames(11, rows=400, heavy=True)
    spark_feed, spark_master = to_spark(spark, feed, master)
    expected = {
        "strict": normal(expected_strict(spec, feed, master)),
        "reference": normal(brute_force(spec, feed, master)),
    }
    spark.conf.set(BROADCAST_LIMIT_KEY, "0")
    try:
        assert spark_rows(match_strict(spec, spark_feed, spark_master)) == expected["strict"]
        assert spark_rows(match_reference(spec, spark_feed, spark_master)) == expected["reference"]
    finally:
        spark.conf.unset(BROADCAST_LIMIT_KEY)


@pytest.mark.parametrize("mode", ["strict", "reference"])
def test_result_does_not_depend_on_partitions(spark, mode):
    spec = SPECS["nordstrom"]
    match = match_strict if mode == "strict" else match_reference
    feed, master = random_frames(5, rows=200)
    spark_feed, spark_master = to_spark(spark, feed, master)
    results = {
        tuple(spark_rows(match(spec, spark_feed.repartition(n).orderBy(F.rand(n)), spark_master)))
        for n in (1, 7)
    }
    assert len(results) == 1


def test_gate_closes_on_any_exception(spark):
    rows = spark.createDataFrame(
        [("A", "final"), ("A", "exception"), ("B", "final"), ("B", "final")], "AccountMajor string, outcome string"
    )
    assert [tuple(r) for r in gate(rows).collect()] == [("B", "final")] * 2


def test_gate_of_few_groups_shuffles_no_rows(spark, tmp_path):
    spark.sql("SELECT 'A' AS AccountMajor, 'exception' AS outcome UNION ALL SELECT 'B', 'final'").write.parquet(str(tmp_path / "t"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        passed = gate(spark.read.parquet(str(tmp_path / "t")), few=True)
        plan = passed._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and plan.count("Exchange hashpartitioning") == 1  # of the failed groups
        assert [r["AccountMajor"] for r in passed.collect()] == ["B"]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_layout_has_the_canonical_columns(spark):
    import datetime as dt

    from posloom.schema import CANONICAL, OUTCOME, SOURCE_ORDER

    feed, master = random_frames(1)
    spark_feed, spark_master = to_spark(spark, feed, master)
    spec = SPECS["target"]
    rows = lay_out(spec, match_strict(spec, spark_feed, spark_master), dt.date(2020, 3, 1))
    assert rows.columns == [*SOURCE_ORDER, *CANONICAL, *OUTCOME, "counted"]
