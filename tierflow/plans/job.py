"""The daily batch job: ingest -> silver + quality per table -> gold ->
reconcile, with an append-only run ledger.

Each step ends in a snapshot write, so the next step scans files (short
lineage, nothing recomputed after an executor loss). Rules are evaluated before
that write, on the rows that can have changed (``incremental.py``). The driver
only holds counts, the per-rule report (one row per rule) and check rows.
"""

from __future__ import annotations

import datetime as dt
import os
import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tierflow.operators import reconcile as rc
from tierflow.operators.quarantine import ACTIONS, QualityBlocked, quarantine_rules
from tierflow.operators.rules import Spec, compile_rules, load_spec, report
from tierflow.plans import gold, models, silver
from tierflow.plans import incremental as inc
from tierflow.plans.bronze import ingest_source
from tierflow.plans.incremental import bronze_keys, grow_keys
from tierflow.session import release_shuffles, work_dir
from tierflow.sinks.store import CODEC, TableStore, isin_values, same_key, upsert
from tierflow.sources.contracts import BANK_CONTRACTS, IngestResult
from tierflow.sources.landing import list_landing_objects, source_of

RULES_DIR = os.path.join(os.path.dirname(__file__), "rules")
#: Which bronze rows completed runs have carried into silver.
PROGRESS_SCHEMA = "run_id string, table_name string, bronze_run string, n_rows long, last_ingested timestamp_ntz"
LEDGER_SCHEMA = ("run_id string, run_date date, seq int, step string, table_name string, status string, "
                 "rows_in long, rows_out long, quarantined long, detail string, elapsed_s double")


@dataclass
class SilverStep:
    """One silver table: ``build(store, bronze)`` turns bronze rows into silver
    rows; with a ``key`` the result is upserted, otherwise it replaces the
    table. ``source`` names the bronze table (default: same as ``table``)."""
    table: str
    key: list[str] | None
    build: Callable[[TableStore, DataFrame], DataFrame]
    source: str | None = None
    partition_by: str | None = None   # e.g. event_date: readers of some days read only their folders
    #: For rows that depend on rows of other keys (a fallback rate): ``state(store,
    #: built)`` gives the tables to remember of a build from all of bronze, and
    #: ``grow(store, bronze, present, state)`` the rows that new bronze rows add
    #: or change, and the new state.
    state: Callable[[TableStore, DataFrame], dict[str, DataFrame]] | None = None
    grow: Callable[[TableStore, DataFrame, DataFrame, Mapping[str, DataFrame]], tuple[DataFrame, dict[str, DataFrame]]] | None = None
    state_tables: Sequence[str] = ()


@dataclass
class JobConfig:
    contracts: Mapping[str, Sequence[str]]
    steps: list[SilverStep]                         # parents first
    specs: Mapping[str, Spec]                        # silver table -> rules
    gold_models: Callable[[TableStore], dict[str, DataFrame]] | str   # builders, or a folder of .sql models
    checks: Callable[[TableStore], DataFrame]
    #: Gold models that a run may bring up to date by the days it changed: model ->
    #: (silver table, its day column, builder from the store and these days).
    grown: Mapping[str, tuple[str, str, Callable[[TableStore, list], DataFrame]]] = field(default_factory=dict)


@dataclass
class RunSummary:
    run_id: str
    run_date: dt.date
    ingested: list[IngestResult] = field(default_factory=list)
    ledger: list[tuple] = field(default_factory=list)
    reports: dict[str, list] = field(default_factory=dict)
    rules: list[tuple] = field(default_factory=list)
    gold_rows: dict[str, int] = field(default_factory=dict)
    checks: list[tuple] = field(default_factory=list)
    verdict: str | None = None
    _mark: float = field(default_factory=time.monotonic, repr=False)

    def log(self, step, table, status, rows_in=None, rows_out=None, quarantined=None, detail=None):
        """Append a ledger row; ``elapsed_s`` is the wall time since the previous row."""
        now = time.monotonic()
        self.ledger.append((self.run_id, self.run_date, len(self.ledger), step, table, status,
                            rows_in, rows_out, quarantined, detail, round(now - self._mark, 3)))
        self._mark = now

    def note_rules(self, table: str, report_rows, decisions) -> None:
        """Keep every rule's outcome, and the action taken, for the ledger."""
        actions = {d["rule_id"]: d["action"] for d in decisions}
        for r in report_rows:
            self.rules.append((table, r["rule_id"], actions.get(r["rule_id"], "warn" if r["failed"] else "ok"),
                               r["total_rows"], r["failed_rows"], r["severity"]))

    def rows(self) -> list[tuple]:
        """The ledger: steps as they happened, then rules, drift and checks."""
        more = [("rule", t, action, total, None, bad, f"{rule} ({severity})") for t, rule, action, total, bad, severity in self.rules]
        more += [("drift", r.table, r.action, None, r.rows, None, f"{r.file}: missing {','.join(r.missing_columns) or '-'}; "
                  f"unexpected {','.join(r.unexpected_columns) or '-'}") for r in self.ingested if r.has_drift]
        more += [("check", None, "ok" if ok else "mismatch", None, None, None, f"{name}: {detail}") for name, ok, detail in self.checks]
        n = len(self.ledger)
        return self.ledger + [(self.run_id, self.run_date, n + i, *m, 0.0) for i, m in enumerate(more)]


def new_run_id(run_date: dt.date) -> str:
    """Sorts by business date, then by the moment the run began."""
    return f"{run_date.isoformat()}.{time.time_ns():x}"


def pending_bronze(store: TableStore, source: str, whole: bool = False) -> tuple[DataFrame, list[tuple], bool]:
    """The rows of ``bronze.<source>`` that no completed run has carried on, what
    to record once they are: (bronze run, rows, last ingest) of all runs, and
    whether these are all rows.

    A bronze run is pending unless the progress table has it with as many rows
    as there are now, whoever wrote it: a failed run, a stream, a single file.
    If a pending row is not newer than all that was carried on, upserting it
    alone could undo a later correction, so then all rows are returned, and with
    ``whole`` always."""
    bronze = store.read("bronze", source)
    state = [tuple(r) for r in bronze.groupBy("_run_id").agg(
        F.count(F.lit(1)), F.max("_ingested_at"), F.min("_ingested_at")).collect()]  # one row per run
    now = [r[:3] for r in state]
    if whole or not store.exists("gold", "run_progress"):
        return bronze, now, True
    carried = {}
    for r in store.read("gold", "run_progress").where(F.col("table_name") == source).groupBy("bronze_run").agg(
            F.max("n_rows").alias("n"), F.max("last_ingested").alias("last")).collect():
        carried[r["bronze_run"]] = (r["n"], r["last"])
    pending = [(run, first) for run, n, _, first in state if carried.get(run, (None,))[0] != n]
    last = max((t for _, t in carried.values() if t is not None), default=None)
    if last is not None and any(first is None or first <= last for _, first in pending):
        return bronze, now, True
    return bronze.where(isin_values(F.col("_run_id"), [run for run, _ in pending])), now, False


def resolver(store: TableStore):
    def ref(name: str) -> DataFrame:
        layer, table = name.split(".")
        return store.read(layer, table)
    return ref


def ensure_quarantine(store: TableStore, table: str) -> None:
    if store.exists("quarantine", table) or not store.exists("silver", table):
        return
    like = store.read("silver", table).limit(0)
    empty = like.select("*", F.lit(None).cast("string").alias("_reject_reason"),
                        F.lit(None).cast("timestamp_ntz").alias("_quarantined_at"))
    store.write("quarantine", table, empty, mode="overwrite")


def decide_rows(report_rows, policy: Mapping[str, str] | None, default: str = "quarantine") -> list[dict]:
    """:func:`tierflow.operators.quarantine.decide` over already-collected
    report rows (one per rule), so no second pass over the data is needed."""
    out = []
    for r in report_rows:
        if r["failed"] and r["severity"] == "error":
            action = (policy or {}).get(r["rule_id"], default)
            if action not in ACTIONS:
                raise ValueError(f"unknown action {action!r}; expected one of {ACTIONS}")
            out.append({**r.asDict(), "action": action})
    return out


def apply_quality(store: TableStore, table: str, spec: Spec, summary: RunSummary,
                  policy: Mapping[str, str] | None = None, rule_ids: Sequence[str] | None = None,
                  release_passing: bool = True, partition_by: str | None = None) -> int:
    """Evaluate ``spec`` on ``silver.<table>``, apply the policy, move rows.

    Returns rows quarantined. Any failed rule whose action is ``block``
    raises :class:`QualityBlocked` before anything is moved."""
    df = store.read("silver", table)
    comp = compile_rules(df, spec.rules, resolver(store))
    frame = comp.frame.persist(StorageLevel.MEMORY_AND_DISK)
    comp.frame = frame
    try:
        rep = report(comp, f"silver.{table}")
        rows = rep.collect()  # one row per rule
        summary.reports[table] = [r.asDict() for r in rows]
        decisions = decide_rows(rows, policy)
        if any(d["action"] == "block" for d in decisions):
            summary.note_rules(table, rows, decisions)
            summary.log("quality", table, "blocked", detail=",".join(
                d["rule_id"] for d in decisions if d["action"] == "block"))
            raise QualityBlocked(f"quality policy blocked the run on silver.{table}")
        summary.note_rules(table, rows, decisions)
        chosen = [d["rule_id"] for d in decisions if d["action"] == "quarantine"]
        if rule_ids is not None:
            chosen = [r for r in chosen if r in rule_ids]
        moved = 0
        if chosen:
            rs = quarantine_rules(comp.rules, chosen)
            flag = comp.any_failed(rs)
            data = [F.col(c) for c in comp.columns]
            bad = frame.where(flag).select(*data, comp.reason(rs).alias("_reject_reason"),
                                           F.localtimestamp().alias("_quarantined_at"))
            good = frame.where(~flag).select(*data)
            o = Observation(f"q_{table}_{uuid.uuid4().hex[:6]}")
            bad = bad.observe(o, F.count(F.lit(1)).alias("n"))
            key = spec.key
            # quarantine first: a crash before the silver rewrite leaves a row
            # in both layers, and the rerun converges (the upsert is idempotent)
            if key and store.exists("quarantine", table):
                target = store.read("quarantine", table)
                if release_passing:
                    target = same_key(target, good, key, "left_anti")
                store.write("quarantine", table, upsert(target, bad, key, null_safe=True), mode="overwrite")
            elif key:
                store.write("quarantine", table, bad, mode="overwrite")
            else:
                store.write("quarantine", table, bad, mode="append")
            moved = int(o.get["n"])
            store.write("silver", table, good, mode="overwrite", partition_by=[partition_by] if partition_by else None)
        else:
            ensure_quarantine(store, table)
            if release_passing and spec.key and store.exists("quarantine", table):
                # nothing failed: every key now in silver passes, so its old
                # quarantined copy is released (only rewritten if one exists)
                q = store.read("quarantine", table)
                if same_key(q, frame, spec.key, "left_semi").limit(1).count():
                    store.write("quarantine", table, same_key(q, frame, spec.key, "left_anti"), mode="overwrite")
        summary.log("quality", table, "ok", rows_in=rows[0]["total_rows"] if rows else 0,
                    rows_out=(rows[0]["total_rows"] - moved) if rows else 0, quarantined=moved,
                    detail=";".join(f"{r['rule_id']}={r['failed_rows']}" for r in rows if r["failed"]))
        return moved
    finally:
        frame.unpersist()


def evaluate_table(store: TableStore, layer: str, table: str, spec: Spec) -> DataFrame:
    """The rule report of ``<layer>.<table>`` (nothing moved); foreign keys
    resolve against the store's tables."""
    return report(compile_rules(store.read(layer, table), spec.rules, resolver(store)), f"{layer}.{table}")


def quarantine_failures(store: TableStore, layer: str, table: str, spec: Spec, *,
                        rule_ids: Sequence[str] | None = None, partition_by: str | None = None) -> int:
    """Move rows violating error rules (optionally only ``rule_ids``) from
    ``<layer>.<table>`` to ``quarantine.<table>``; returns rows moved."""
    if layer != "silver":
        raise ValueError("quarantine moves rows out of silver tables")
    summary = RunSummary(run_id="adhoc", run_date=dt.date.today())
    return apply_quality(store, table, spec, summary, rule_ids=rule_ids, partition_by=partition_by)


class _Settling:
    """The silver and quality steps of one run."""

    def __init__(self, store: TableStore, config: JobConfig, summary: RunSummary, policy: Mapping[str, str] | None,
                 release_passing: bool, incremental_run: bool):
        self.store, self.config, self.summary, self.policy, self.release_passing = store, config, summary, policy, release_passing
        self.rules = {s.table: repr((config.specs[s.table].rules if s.table in config.specs else [], sorted((policy or {}).items()), release_passing))
                      for s in config.steps if s.key}
        self.partly = incremental_run and inc.settled(store, self.rules)
        self.changed: dict[tuple[str, str], DataFrame] = {}   # of parents: values that came or went
        self.remember: dict[str, DataFrame] = {}
        self.days: dict[tuple[str, str], list | None] = {}    # days of a table that changed; absent: any may have
        self.grown = {name for name in config.grown if self.partly and inc.model_settled(store, name)}
        self.passing: list[str] = []    # staged folders that only the step at hand reads
        self.lasting: list[str] = []    # those that later steps read
        self.watched = {(r.ref, r.ref_column) for spec in config.specs.values() for r in spec.rules if r.type == "foreign_key"}

    def staged(self, df: DataFrame, name: str, lasting: bool = False) -> DataFrame:
        path = work_dir(self.store.spark, f"stage-{name}")
        (self.lasting if lasting else self.passing).append(path)
        df.write.parquet(path, compression=CODEC)
        release_shuffles(self.store.spark)
        return self.store.spark.read.schema(df.schema).parquet(path)

    def step_over(self) -> None:
        """Delete what only this step has read."""
        while self.passing:
            self.store.remove(self.passing.pop())
        release_shuffles(self.store.spark)

    def close(self) -> None:
        """Delete all that was staged: a later run stages anew."""
        self.passing += self.lasting
        self.lasting.clear()
        self.step_over()

    def build(self, step: SilverStep, bronze: DataFrame, whole: bool) -> tuple[DataFrame, int]:
        """The step's rows, written once (they are read several times, and their
        lineage ends here), and how many there are."""
        store, o = self.store, Observation(f"s_{step.table}_{uuid.uuid4().hex[:6]}")
        grown = not whole and step.grow is not None
        if grown:
            cols = store.read("silver", step.table).columns
            built, state = step.grow(store, bronze, inc.present_rows(store, step.table, cols, step.key),
                                     {t: store.read("gold", t) for t in step.state_tables})
        else:
            built, state = step.build(store, bronze), {}
        built = self.staged(built.observe(o, F.count(F.lit(1)).alias("n")), step.table)
        if step.state is not None and not grown:
            state = step.state(store, built)
        self.remember |= {name: self.staged(df, name, lasting=True) for name, df in state.items()}
        return built, int(o.get["n"])

    def keyed(self, step: SilverStep, bronze: DataFrame, all_of_bronze: bool) -> None:
        """Judge the step's rows and all that depend on them, and write both layers."""
        store, t, key, spec = self.store, step.table, step.key, self.config.specs.get(step.table) or Spec(None, None, [])
        remembered = all(store.exists("gold", name) for name in step.state_tables)
        built, n = self.build(step, bronze, all_of_bronze or (step.grow is not None and not (self.partly and remembered)))
        before = store.current("silver", t)
        present = inc.present_rows(store, t, built.columns, key) if before and set(built.columns) <= set(store.read("silver", t).columns) else None
        rest = None if present is None else same_key(present, built, key, "left_anti") if n else present
        old = None if present is None else same_key(present, built, key, "left_semi") if n else present.where(F.lit(False))
        replaced = present is not None and self.replaces(t, built, n, key)
        parents = all((r.ref, r.ref_column) in self.changed for r in spec.rules if r.type == "foreign_key")
        if rest is None or replaced:
            judged = built
        elif self.partly and parents:
            more = inc.affected(rest, built, old, spec, key, self.changed)
            judged = built if more is None else built.unionByName(self.staged(more, f"judged-{t}"))
        else:
            judged = built.unionByName(self.staged(rest, f"judged-{t}"))
        self.summary.log("silver", t, "ok", rows_out=n)

        universe = built if rest is None or replaced else rest.unionByName(built)
        comp = compile_rules(judged, spec.rules, resolver(store), universe=universe)
        comp.frame = frame = comp.frame.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            rows, chosen = self.decide(t, spec, comp)
            rs = quarantine_rules(comp.rules, chosen) if chosen else []
            flag, data = comp.any_failed(rs), [F.col(f"`{c}`") for c in comp.columns]
            good = frame.where(~flag).select(*data)
            bad = frame.where(flag).select(*data, comp.reason(rs).alias("_reject_reason"), F.localtimestamp().alias("_quarantined_at"))
            moved = self.quarantine(t, key, judged, bad, bool(chosen))
            for column in {c for name, (table, c, _) in self.config.grown.items() if table == t and name in self.grown}:
                if rest is not None and parents:
                    self.days[t, column] = inc.changed_values(judged, old, column)
            past = None if before is None else store.read_at(before)
            if past is None:
                new = good
            elif replaced and dict(past.dtypes) == dict(good.dtypes):
                new = good.select(*[F.col(f"`{c}`") for c in past.columns])
            else:
                new = same_key(past, judged, key, "left_anti").unionByName(good, allowMissingColumns=True)
            store.write("silver", t, new, mode="overwrite", partition_by=[step.partition_by] if step.partition_by else None)
            if spec.rules:
                total = rows[0]["total_rows"]
                self.summary.log("quality", t, "ok", rows_in=total, rows_out=total - moved, quarantined=moved,
                                 detail=";".join(f"{r['rule_id']}={r['failed_rows']}" for r in rows if r["failed"]))
        finally:
            frame.unpersist()
        for ref, column in self.watched:
            if ref == f"silver.{t}":
                then = None if before is None else store.read_at(before)
                past = None if list(key) == [column] else old   # old versions have the same key, so no other value
                self.changed[ref, column] = self.staged(inc.came_or_went(then, store.read("silver", t), judged, past, column), f"came-{t}", lasting=True)

    def replaces(self, t: str, built: DataFrame, n: int, key: Sequence[str]) -> bool:
        """Whether the ``n`` built rows have all keys of both layers, so that no
        row stays as it is. Not looked up if they are fewer than silver's."""
        layers = [self.store.read(layer, t) for layer in ("silver", "quarantine") if self.store.exists(layer, t)]
        return n >= layers[0].count() and inc.covers(built, layers, key)

    def decide(self, t: str, spec: Spec, comp) -> tuple[list, list[str]]:
        """The report of the judged rows, and the rules whose failures move."""
        if not spec.rules:
            return [], []
        rows = report(comp, f"silver.{t}").collect()  # one row per rule
        self.summary.reports[t] = [r.asDict() for r in rows]
        decisions = decide_rows(rows, self.policy)
        self.summary.note_rules(t, rows, decisions)
        if any(d["action"] == "block" for d in decisions):
            self.summary.log("quality", t, "blocked", detail=",".join(d["rule_id"] for d in decisions if d["action"] == "block"))
            raise QualityBlocked(f"quality policy blocked the run on silver.{t}")
        return rows, [d["rule_id"] for d in decisions if d["action"] == "quarantine"]

    def quarantine(self, t: str, key: Sequence[str], judged: DataFrame, bad: DataFrame, some: bool) -> int:
        """Write quarantine, before silver: a crash in between leaves a row in
        both layers, and the next run, which then judges everything, settles it."""
        store = self.store
        if not store.exists("quarantine", t):
            o = Observation(f"q_{t}_{uuid.uuid4().hex[:6]}")
            store.write("quarantine", t, bad.observe(o, F.count(F.lit(1)).alias("n")), mode="overwrite")
            return int(o.get["n"])
        held = store.read("quarantine", t)
        gone = judged if self.release_passing else bad
        if not some and not same_key(held, gone, key, "left_semi").limit(1).count():
            return 0
        o = Observation(f"q_{t}_{uuid.uuid4().hex[:6]}")
        bad = bad.observe(o, F.count(F.lit(1)).alias("n"))
        store.write("quarantine", t, same_key(held, gone, key, "left_anti").unionByName(bad, allowMissingColumns=True), mode="overwrite")
        return int(o.get["n"]) if some else 0

    def brought_up(self, name: str, whole: DataFrame) -> tuple[DataFrame, str | None]:
        """The gold model ``name``: from the days that changed, if they are known
        and the model is as the last completed run left it, else ``whole``."""
        table, column, grow = self.config.grown.get(name, (None, None, None))
        days = self.days.get((table, column)) if name in self.grown else None
        if days is None or set(whole.columns) != set(self.store.read("gold", name).columns):
            return whole, None
        return grow(self.store, days), f"{len(days)} days anew"

    def done(self) -> None:
        """Remember what this run ended with (it was completed)."""
        for name, df in self.remember.items():
            self.store.write("gold", name, df, mode="overwrite")
        inc.write_state(self.store, self.rules, [n for n in self.config.grown if self.store.exists("gold", n)])


def run_daily(spark: SparkSession, config: JobConfig, landing_dir: str, lake_root: str,
              run_date: dt.date, *, run_id: str | None = None, on_drift: str = "raise",
              policy: Mapping[str, str] | None = None, ingested_at=None,
              release_passing: bool = True, ledger: bool = True, incremental: bool = True,
              keep_versions: int | None = 2) -> RunSummary:
    """Run one business date end to end.

    After a successful run, snapshots older than the newest
    ``keep_versions`` are removed from silver, quarantine and gold
    (``None`` keeps every version; bronze is append-only and never pruned).

    ``incremental`` (default) builds a keyed silver table from the bronze rows
    that no completed run has carried on (see :func:`pending_bronze`), converts
    and judges these rows and the ones that depend on them (see
    ``incremental.py``), and counts bronze's distinct keys by those that are new;
    rules then report the rows that were judged. ``incremental=False`` builds
    from all of bronze and judges every row. Both end in the same silver and
    quarantine: after a run that was not completed, after tables or rules were
    changed otherwise, and for deliveries that are not newer than what was
    carried on, everything is judged either way. Null is a key like any other.
    A key that passes leaves quarantine unless ``release_passing`` is off."""
    store = TableStore(spark, lake_root)
    summary = RunSummary(run_id=run_id or new_run_id(run_date), run_date=run_date)
    stamp = f"{run_date:%Y%m%d}"
    files = list_landing_objects(spark, landing_dir, stamp)
    if not files:
        raise FileNotFoundError(f"{landing_dir} has nothing stamped {stamp}")
    settling = None
    try:
        by_source: dict[str, list[str]] = {}
        for path in files:  # name order; one ingest job per source
            by_source.setdefault(source_of(path, list(config.contracts)), []).append(path)
        for src, paths in by_source.items():
            for res in ingest_source(store, src, paths, summary.run_id, config.contracts[src],
                                     on_drift=on_drift, ingested_at=ingested_at):
                summary.ingested.append(res)
                summary.log("ingest", res.table, res.action, rows_out=res.rows, detail=res.file)
        progress: list[tuple] = []
        settling = _Settling(store, config, summary, policy, release_passing, incremental)
        for step in config.steps:
            source = step.source or step.table
            bronze, carried, whole = pending_bronze(store, source, whole=not (incremental and step.key))
            progress += [(summary.run_id, source, *c) for c in carried]
            if step.key:
                settling.keyed(step, bronze, whole)
                settling.step_over()
                grow_keys(store, source, bronze, step.key)
                continue
            built, n = settling.build(step, bronze, True)
            store.write("silver", step.table, built, mode="overwrite", partition_by=[step.partition_by] if step.partition_by else None)
            summary.log("silver", step.table, "ok", rows_out=n)
            spec = config.specs.get(step.table)
            if spec and spec.rules:
                apply_quality(store, step.table, spec, summary, policy=policy,
                              release_passing=release_passing, partition_by=step.partition_by)
            settling.step_over()
        gold_models = models.run_folder(store, config.gold_models) if isinstance(config.gold_models, str) \
            else sorted(config.gold_models(store).items())
        for name, df in gold_models:
            df, detail = settling.brought_up(name, df)
            o = Observation(f"g_{name}_{uuid.uuid4().hex[:6]}")
            store.write("gold", name, df.observe(o, F.count(F.lit(1)).alias("n")), mode="overwrite")
            n = int(o.get["n"])
            summary.gold_rows[name] = n
            summary.log("gold", name, "ok", rows_out=n, detail=detail)
            release_shuffles(spark)
        rows = config.checks(store).collect()  # one small row per check
        summary.checks = [tuple(r) for r in rows]
        summary.verdict = rc.verdict(spark.createDataFrame(rows, rc.CHECK_SCHEMA)).first()["verdict"]
        summary.log("validate", None, summary.verdict,
                    detail="; ".join(f"{n}={'ok' if ok else 'MISMATCH'}" for n, ok, _ in summary.checks))
        settling.done()
        if progress:
            store.write("gold", "run_progress", spark.createDataFrame(progress, PROGRESS_SCHEMA).coalesce(1), mode="append")
        if keep_versions:
            # old full snapshots of rewritten tables are not kept forever
            for layer in ("silver", "quarantine", "gold"):
                for t in store.list_tables(layer):
                    store.vacuum(layer, t, keep=keep_versions)
    except Exception as ex:
        summary.log("failure", None, "aborted", detail=f"{type(ex).__name__}: {ex}"[:500])
        raise
    finally:
        if settling:
            settling.close()
        if ledger:
            write_ledger(store, summary)
    return summary


def write_ledger(store: TableStore, summary: RunSummary) -> None:
    df = store.spark.createDataFrame(summary.rows(), LEDGER_SCHEMA)
    store.write("gold", "run_ledger", df, mode="append")


# -- the banking configuration --------------------------------------------------

def bank_specs() -> dict[str, Spec]:
    return {t: load_spec(os.path.join(RULES_DIR, f"silver_{t}.yml"))
            for t in ("customers", "accounts", "transactions")}


def bank_gold(store: TableStore) -> dict[str, DataFrame]:
    return {name: build(store) for name, build in gold.BANK_MODELS.items()}


# The KPI baseline of the banking checks (expected daily
# flagged-transaction percentage and the tolerated multiple of it).
EXPECTED_FRAUD_RATE_PCT = 0.5
FRAUD_TOLERANCE = 3.0


def bank_checks(store: TableStore, expected_fraud_rate_pct: float = EXPECTED_FRAUD_RATE_PCT,
                fraud_tolerance: float = FRAUD_TOLERANCE) -> DataFrame:
    checks = []
    for table, key in (("customers", "customer_id"), ("accounts", "account_id"), ("transactions", "txn_id")):
        q = store.read("quarantine", table) if store.exists("quarantine", table) else None
        keys, once = bronze_keys(store, table, key)
        checks.append(rc.row_conservation(table, keys, store.read("silver", table), q, key, once=once))
    checks.append(rc.amount_conservation("fact", store.read("silver", "transactions"),
                                         store.read("gold", "fact_transactions"), "amount_bob"))
    checks.append(rc.no_orphans("fact", store.read("gold", "fact_transactions"), "customer_id"))
    checks.append(rc.kpi_baseline("fraud_rate", store.read("gold", "kpi_daily"), "fraud_flag_rate_pct",
                                  expected_fraud_rate_pct, fraud_tolerance))
    return rc.combine(checks)


def transactions_step(fx_fallback: str | None) -> SilverStep:
    """Transactions; a missing rate is filled from the currency's other rows."""
    def rates(s: TableStore) -> DataFrame:
        return s.read("silver", "fx_rates")

    def grow(s: TableStore, b: DataFrame, present: DataFrame, state: Mapping[str, DataFrame]):
        return inc.grow_converted(silver.type_transactions(b), present, rates(s), state, ["txn_id"], fx_fallback or "none")
    return SilverStep("transactions", ["txn_id"], lambda s, b: silver.build_transactions(b, rates(s), fx_fallback), partition_by="event_date",
                      state=lambda s, built: inc.fx_state(built, rates(s), fx_fallback or "none"), grow=grow,
                      state_tables=inc.FX_STATE)


def bank_config(fx_fallback: str | None = "last_row") -> JobConfig:
    specs = bank_specs()
    return JobConfig(
        contracts=BANK_CONTRACTS,
        steps=[
            SilverStep("fx_rates", ["rate_date", "currency"], lambda s, b: silver.build_fx_rates(b)),
            SilverStep("customers", ["customer_id"], lambda s, b: silver.build_customers(b)),
            SilverStep("accounts", ["account_id"], lambda s, b: silver.build_accounts(b)),
            transactions_step(fx_fallback),
        ],
        specs=specs, gold_models=bank_gold, checks=bank_checks, grown=gold.BANK_GROWN)
