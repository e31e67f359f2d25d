"""The weekly run: files to outcomes to published tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from posloom.operators.control import observed
from posloom.operators.membership import invalid_items, not_yet_run
from posloom.operators.sets import append
from posloom.plans.accounts import ACCOUNTS
from posloom.plans.engine import layout_errors, run_account, sheet_rows
from posloom.plans.master import Master, master_from_grid, measured
from posloom.plans.publish import Sinks, publish, read_ledger, stage, unstage
from posloom.plans.spec import STRICT, AccountSpec
from posloom.schema import CROSSREF_HEADERS, EXCEPTION, FINAL
from posloom.sources import files as listing
from posloom.sources import grid as g
from posloom.sources.text import delimited_grid
from posloom.sources.workbook import decode

RAW_FILES = "*.{xlsx,csv,tsv,txt}"
SEPARATORS = {".csv": ",", ".tsv": "\t", ".txt": "\t"}


@dataclass(frozen=True)
class WeeklyRun:
    """Outcomes, the files they came from, and the checks of the run.

    ``invalid_items`` are master items the warehouse does not list, ``not_run``
    the accounts missing from the consolidated table before this run (both None
    if that table was not given). ``metrics`` has the feed rows and amount of
    each account, counted while they passed by.
    """

    rows: DataFrame
    files: DataFrame
    missing: tuple[str, ...]
    metrics: dict[str, dict]
    invalid_items: DataFrame | None = None
    not_run: DataFrame | None = None

    def close(self) -> None:
        """Remove the staged outcomes; ``rows`` cannot be read afterwards."""
        unstage(self.rows.sparkSession, self.rows)

    def reconciliation(self) -> DataFrame:
        """Feed against outcomes, per account: rows, amounts, and do they balance?

        Holds in strict mode, where every feed row has one outcome.
        """
        spark = self.rows.sparkSession
        fed = spark.createDataFrame(
            [(name, found["rows"], found["amount"]) for name, found in self.metrics.items()],
            "AccountMajor string, feed_rows long, feed_amount decimal(38,4)",
        )
        out = self.rows.groupBy("AccountMajor").agg(
            F.count_if(F.col("outcome") == FINAL).alias("final_rows"),
            F.count_if(F.col("outcome") == EXCEPTION).alias("exception_rows"),
            F.coalesce(F.sum("POSAmount"), F.lit(0)).cast("decimal(38,4)").alias("outcome_amount"),
        )
        joined = fed.join(out, "AccountMajor", "left").na.fill(0, ["final_rows", "exception_rows", "outcome_amount"])
        same = F.col("feed_rows") == F.col("final_rows") + F.col("exception_rows")
        return joined.withColumn("balanced", same & (F.col("feed_amount") == F.col("outcome_amount")))


class LayoutError(ValueError):
    """Workbooks lack sheets or columns; the message names all of them."""


def account_tokens(accounts: dict[str, AccountSpec] = ACCOUNTS) -> dict[str, str]:
    """File token -> itself, for every token any account goes by."""
    return {token: token for spec in accounts.values() for token in spec.tokens}


def select_files(
    spark: SparkSession, raw_dir: str, tokens: dict[str, str], ledger: str | None = None
) -> DataFrame:
    """The latest workbook or delimited export per account token that the ledger does not hold."""
    found = listing.files_of_accounts(listing.list_files(spark, raw_dir, RAW_FILES), tokens)
    latest = listing.latest_per_account(found)
    return listing.not_processed(latest, read_ledger(spark, ledger)) if ledger else latest


def load_grid(spark: SparkSession, files: DataFrame) -> tuple[DataFrame, list[str]]:
    """Cells of the selected files, read once and staged by token.

    Only paths come to the driver, one per account token, to name the files to
    open; that is the file listing any reader makes. Delimited exports are read
    in splits by Spark, workbooks are decoded file by file.
    """
    pairs = [(row["path"], row["account"]) for row in files.select("account", "path").collect()]
    if not pairs:
        raise FileNotFoundError("no workbook of any account found")
    grid = read_cells(spark, sorted({path for path, _ in pairs}))
    by_path = spark.createDataFrame(pairs, "path string, token string")
    keyed = grid.join(F.broadcast(by_path), "path")  # a file of two accounts goes to both
    return stage(keyed, spark, "grid", ("token",)), sorted({token for _, token in pairs})


def read_cells(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Grid rows of workbooks and delimited exports alike."""
    parts = []
    for end, sep in SEPARATORS.items():
        mine = [p for p in paths if p.lower().endswith(end)]
        if mine:
            parts.append(delimited_grid(spark, mine, sep))
    books = [p for p in paths if not p.lower().endswith(tuple(SEPARATORS))]
    if books:
        parts.append(decode(spark.read.format("binaryFile").load(books)))
    return append(*parts)


def with_majors(files: DataFrame, accounts: dict[str, AccountSpec]) -> DataFrame:
    """The file list with the account each token publishes under."""
    majors = [(token, spec.account_major) for spec in accounts.values() for token in spec.tokens]
    known = files.sparkSession.createDataFrame(sorted(set(majors)), "account string, major string")
    return files.join(F.broadcast(known), "account")


def load_master(spark: SparkSession, path: str, sheet: str, header_row: int = 6) -> Master:
    """The item master sheet, read once and staged."""
    grid = read_cells(spark, [path])
    return measured(stage(master_from_grid(grid, sheet, header_row), spark, "master"))


def load_crossref(spark: SparkSession, path: str, sheet: str, header_row: int = 0) -> Master:
    """An account's own cross reference sheet, as the master it is matched to."""
    rows = master_from_grid(read_cells(spark, [path]), sheet, header_row, CROSSREF_HEADERS)
    return measured(stage(rows, spark, "crossref"))


def account_grid(grid: DataFrame, spec: AccountSpec, accounts: dict[str, AccountSpec]) -> DataFrame:
    """The account's cells; where accounts share files, those of its layout."""
    mine = grid.filter(F.col("token").isin(*spec.tokens))
    if spec.layout.signature is None:
        return mine
    rivals = [s for s in accounts.values() if s.tokens == spec.tokens and s.layout.signature]
    signatures = {s.name: (s.layout.header_row, s.layout.signature) for s in rivals}
    first_sheet = g.sheet_at(mine, 0)
    return g.of_layout(first_sheet, signatures, spec.name)


def run_grid(
    grid: DataFrame,
    tokens: list[str],
    master: Master | None,
    run_date: dt.date,
    accounts: dict[str, AccountSpec] = ACCOUNTS,
    mode: str = STRICT,
    watched: dict[str, Observation] | None = None,
    crossrefs: Mapping[str, Master] | None = None,
) -> DataFrame:
    """Outcomes of every account that has a file, as one table.

    An account with a cross reference of its own is matched to that, all others
    to the item master. With ``watched`` an observation of each account's feed is
    put there.
    """
    own = crossrefs or {}
    parts = []
    for spec in present_accounts(tokens, accounts):
        def watch(feed: DataFrame, name: str = spec.name) -> DataFrame:
            feed, watched[name] = observed(feed, f"feed {name}")
            return feed

        rows = sheet_rows(spec, account_grid(grid, spec, accounts), mode)
        known = own.get(spec.name, master)
        if known is None:
            raise ValueError(f"neither an item master nor a cross reference for {spec.name}")
        parts.append(run_account(spec, rows, known, run_date, mode, None if watched is None else watch).rows)
    return append(*parts)


def present_accounts(tokens: list[str], accounts: dict[str, AccountSpec]) -> list[AccountSpec]:
    return [spec for spec in accounts.values() if set(spec.tokens) & set(tokens)]


def check_layouts(grid: DataFrame, tokens: list[str], accounts: dict[str, AccountSpec] = ACCOUNTS) -> None:
    """Stop before anything is matched if a file lacks a sheet or a column.

    What comes to the driver is a row per file and missing column.
    """
    specs = present_accounts(tokens, accounts)
    found = append(*[layout_errors(s, account_grid(grid, s, accounts)) for s in specs]).collect()
    if found:
        raise LayoutError("; ".join(sorted(f"{r['account']}: {r['path']}: {r['problem']}" for r in found)))


def metrics_of(watched: dict[str, Observation], accounts: dict[str, AccountSpec]) -> dict[str, dict]:
    """Feed rows and amount by account, of the observations of a finished run."""
    out: dict[str, dict] = {}
    for name, observation in watched.items():
        found = observation.get
        total = out.setdefault(accounts[name].account_major, {"rows": 0, "amount": Decimal(0)})
        total["rows"] += found["rows"]
        total["amount"] += Decimal(found["amount"])
    return out


def run(
    spark: SparkSession,
    raw_dir: str,
    master_path: str | None,
    master_sheet: str | None,
    out: str,
    run_date: dt.date,
    accounts: dict[str, AccountSpec] = ACCOUNTS,
    mode: str = STRICT,
    ledger: str | None = None,
    warehouse: DataFrame | None = None,
    consolidated: DataFrame | None = None,
    crossrefs: Mapping[str, tuple[str, str]] | None = None,
) -> WeeklyRun:
    """Find, read, check, match and publish the latest file of every account.

    ``crossrefs`` names path and sheet of the cross reference that an account is
    matched to instead of the item master, which only the others need.

    Rows and the list of files that are done are published by one commit. With a
    ``ledger`` folder commits are kept there, and files that an earlier run
    published are left alone; a file held back by exceptions comes up again.
    """
    tokens = account_tokens(accounts)
    files = with_majors(select_files(spark, raw_dir, tokens, ledger), accounts)
    grid, present = load_grid(spark, files)
    master = load_master(spark, master_path, master_sheet) if master_path else None
    own = {name: load_crossref(spark, *where) for name, where in (crossrefs or {}).items()}
    check_layouts(grid, present, accounts)
    watched: dict[str, Observation] = {}
    rows = run_grid(grid, present, master, run_date, accounts, mode, watched, own)
    staged = publish(spark, rows, Sinks.under(out, ledger), files)
    missing = tuple(t for t in tokens if t not in present)
    unstage(spark, grid)
    for known in [*own.values(), *([master] if master and warehouse is None else [])]:
        unstage(spark, known.rows)
    return WeeklyRun(
        staged,
        files,
        missing,
        metrics_of(watched, accounts),
        None if warehouse is None or master is None else validate_master(master, warehouse),
        None if consolidated is None else accounts_not_run(consolidated, accounts),
    )


def accounts_not_run(consolidated: DataFrame, accounts: dict[str, AccountSpec] = ACCOUNTS) -> DataFrame:
    """Accounts the consolidated table has no rows of."""
    majors = sorted({spec.account_major for spec in accounts.values()})
    wanted = consolidated.sparkSession.createDataFrame([(m,) for m in majors], "AccountMajor string")
    return not_yet_run(wanted, consolidated, "AccountMajor", "AccountMajor")


def validate_master(master: Master, warehouse: DataFrame) -> DataFrame:
    """Item numbers the warehouse does not know: a report, never a gate."""
    return invalid_items(master.rows, warehouse)
