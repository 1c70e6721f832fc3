"""The daily run: every open report config from the stored master to its outputs and run state."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from shipreport.functions.text import col
from shipreport.operators import runstate
from shipreport.operators.lookups import accounts_by_pattern, explicit_accounts, group_accounts, without_group
from shipreport.plans.periods import period_window
from shipreport.plans.registry import Context
from shipreport.plans.report import ReportConfig, build_report, expand_combined, touched_columns, write_report
from shipreport.session import stored
from shipreport.sinks.outputs import append_snapshot
from shipreport.sources.shipments import scan_period


@dataclass
class RunInputs:
    """What a run needs besides the master: the ledger, the last counts, and tables by report name."""

    ledger: DataFrame
    last_counts: DataFrame | None = None
    listings: dict[str, DataFrame] = field(default_factory=dict)
    patches: dict[str, DataFrame] = field(default_factory=dict)
    receiver_words: list[str] = field(default_factory=list)


@dataclass
class RunResult:
    """Rows per written report, today's status counts, what changed, the new ledger, and what to send to whom."""

    manifest: DataFrame
    counts: DataFrame
    changes: DataFrame
    ledger: DataFrame
    contacts: DataFrame


def config_keys(configs: list[ReportConfig]) -> list[str]:
    """The ledger key of each config: its name, after the workbook it goes to; equal keys numbered from the second on."""
    seen: dict[str, int] = {}
    keys = []
    for c in configs:
        base = f"{c.move_to_sheet_of_file}/{c.name}" if c.move_to_sheet_of_file else c.name
        seen[base] = seen.get(base, 0) + 1
        keys.append(base if seen[base] == 1 else f"{base} #{seen[base]}")
    return keys


def open_configs(spark: SparkSession, criteria: list[dict], ledger: DataFrame, ctx: Context) -> list[tuple[str, ReportConfig]]:
    """(key, config) of the configs, combined ones expanded, that the ledger does not date today; a few per run.

    Configs of one name stay apart: the key holds the workbook a config goes to and a number
    where even that is equal.
    """
    configs = list(map(ReportConfig.from_dict, expand_combined(criteria)))
    keyed = list(zip(config_keys(configs), configs))
    work = spark.createDataFrame([(key,) for key, _ in keyed], "key string")
    still = {r.key for r in runstate.not_yet_processed(work, ledger, ctx.as_of).collect()}  # one row a config
    return [(key, c) for key, c in keyed if key in still]


def shared_bases(spark: SparkSession, root: str, configs: list[ReportConfig], inputs: RunInputs, ctx: Context) -> dict[str | None, DataFrame]:
    """One stored base for each category: the folders of the widest window, the columns any of its reports can touch.

    Each report still takes its own newest rows from it, after its own filters. A
    report with a file filter reads the master itself, where files have names.
    """
    out = {}
    for category in dict.fromkeys(c.category for c in configs):
        mine = [c for c in configs if c.category == category]
        windows = [period_window(c.period, c.jumlah_bulan, ctx.as_of) for c in mine]
        scan = scan_period(spark, root, min(w[0] for w in windows), max(w[1] for w in windows), category=category)
        wanted = {c for m in mine for c in touched_columns(scan, m, inputs.patches.get(m.name))}
        out[category] = stored(scan.select(*[col(c) for c in scan.columns if c in wanted]), "base")
    return out


def daily_run(spark: SparkSession, criteria: list[dict], root: str, out: str, snapshots: str, ctx: Context, inputs: RunInputs) -> RunResult:
    """Build and write every open report, and move the run state on.

    ``root`` is the master as ``write_shipments`` stores it, ``out`` gets a folder per
    report, ``snapshots`` the status counts. A config without accounts takes those of
    its group from the project table. A run that is repeated writes the same outputs.
    """
    keyed = open_configs(spark, criteria, inputs.ledger, ctx)
    configs = [c for _, c in keyed]
    plain = [c for c in configs if not (c.parquet_name_contains or c.parquet_path_contains)]
    bases = shared_bases(spark, root, plain, inputs, ctx)
    resolved = named_accounts(spark, [c for c in configs if not c.id_account], ctx)
    manifest, counts = [], []
    for number, (key, config) in enumerate(keyed):
        window = period_window(config.period, config.jumlah_bulan, ctx.as_of)
        source = bases[config.category] if config in plain else scan_period(spark, root, *window, category=config.category)
        accounts = None if config.id_account else resolved.where(col("group_name").isin(_names(config))).select("account_id").distinct()
        rows = stored(build_report(
            source, config, ctx, accounts=accounts, patch=inputs.patches.get(config.name), listing=inputs.listings.get(config.name),
            receiver_words=inputs.receiver_words, normalised_ids=True), "report")
        write_report(rows, config, f"{out}/{number:04d}")
        manifest.append(rows.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(config.name).alias("report"), F.lit(key).alias("key"), F.lit(f"{out}/{number:04d}").alias("path"), "n_rows"))
        if "STATUS_POD" in rows.columns:
            append_snapshot(rows, snapshots, config.name, ctx.as_of)
            counts.append(runstate.status_counts(rows, config.name))
    none = spark.createDataFrame([], "report string, status string, n long")
    today = reduce(DataFrame.unionByName, counts, none)
    done = spark.createDataFrame([(c.name, key, _contacts(c)) for key, c in keyed], "report string, key string, contacts array<string>")
    changes = runstate.report_changes(done, today, inputs.last_counts if inputs.last_counts is not None else none, ctx.as_of)
    empty = spark.createDataFrame([], "report string, key string, path string, n_rows long")
    return RunResult(reduce(DataFrame.unionByName, manifest, empty), today, changes,
                     runstate.retained(runstate.marked_processed(inputs.ledger, done.select("key"), ctx.as_of), ctx.as_of),
                     runstate.outputs_per_contact(done, changes))


def _names(config: ReportConfig) -> list[str]:
    given = [config.group_name] if isinstance(config.group_name, str) else list(config.group_name or [])
    return [n.strip().upper() for n in given if n is not None]


def named_accounts(spark: SparkSession, configs: list[ReportConfig], ctx: Context) -> DataFrame | None:
    """(group_name, account_id, source) for the names of configs without their own accounts.

    A name takes the accounts of its group; a name that is no group is matched against the
    customer names through the gram index, all inside Spark.
    """
    if not configs:
        return None
    projects = ctx.ref("project_reference")
    wanted = spark.createDataFrame(sorted({(n,) for c in configs for n in _names(c)}), "group_name string").withColumn("account_id", F.lit(None).cast("string"))
    groups = group_accounts(projects)
    return explicit_accounts(wanted, groups, accounts_by_pattern(projects, without_group(wanted, groups)))


def _contacts(config: ReportConfig) -> list[str]:
    given = config.contact or []
    return [str(given)] if isinstance(given, str) else [str(c) for c in given]
