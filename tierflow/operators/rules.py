"""Declarative data-quality rules compiled to one masked DataFrame.

Rule types (a row *fails* when the mask is true; masks are never null):

* ``not_null``        column is null
* ``unique``          the column value (or column tuple) occurs more than once;
                      every copy fails, repeated nulls count as duplicates
* ``allowed_values``  non-null and not in ``values``
* ``range``           non-null and < ``min`` or > ``max`` (inclusive bounds,
                      either optional, at least one required)
* ``foreign_key``     non-null and absent from ``ref``'s ``ref_column``
* ``fail_when``       the SQL predicate ``expr`` is true (null passes)

Compilation adds, per distinct ``unique`` column set, one grouped count joined
back (map-side partial aggregation, so a hot key is pre-counted before the
shuffle) and, per ``foreign_key`` rule, one left join to the parent's
*distinct* keys (no row multiplication). Then a single projection adds every
mask column; report, samples, reject reasons and the quarantine split all
derive from that one frame.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


RULE_TYPES = ("not_null", "unique", "allowed_values", "range", "foreign_key", "fail_when")
SEVERITIES = ("error", "warn")


@dataclass(frozen=True)
class Rule:
    id: str
    type: str
    column: str | tuple[str, ...] | None = None
    severity: str = "error"
    values: tuple | None = None
    min: Any = None
    max: Any = None
    ref: str | None = None
    ref_column: str | None = None
    expr: str | None = None

    @property
    def columns(self) -> list[str]:
        if self.column is None:
            return []
        return [self.column] if isinstance(self.column, str) else list(self.column)

    @property
    def column_label(self) -> str | None:
        return None if self.column is None else ",".join(self.columns)

    @staticmethod
    def from_dict(d: Mapping) -> Rule:
        kind = d.get("type")
        if kind not in RULE_TYPES:
            raise ValueError(f"unknown rule type {kind!r} in rule {d.get('id')!r}")
        col = d.get("column")
        if isinstance(col, list):
            col = tuple(col)
        sev = d.get("severity", "error") or "error"
        if sev not in SEVERITIES:
            raise ValueError(f"unknown severity {sev!r} in rule {d.get('id')!r}")
        if kind == "range" and "min" not in d and "max" not in d:
            raise ValueError(f"range rule {d.get('id')!r} needs min and/or max")
        vals = d.get("values")
        return Rule(id=d["id"], type=kind, column=col, severity=sev,
                    values=tuple(vals) if vals is not None else None,
                    min=d.get("min"), max=d.get("max"), ref=d.get("ref"),
                    ref_column=d.get("ref_column"), expr=d.get("expr"))


@dataclass
class Spec:
    table: str | None
    key: list[str] | None
    rules: list[Rule] = field(default_factory=list)

    @staticmethod
    def from_dict(d: Mapping | None) -> Spec:
        d = d or {}
        key = d.get("key")
        if isinstance(key, str):
            key = [key]
        return Spec(table=d.get("table"), key=key, rules=[Rule.from_dict(r) for r in d.get("rules", [])])

    def select(self, *, severity: str | None = None, rule_ids: Sequence[str] | None = None) -> list[Rule]:
        return [r for r in self.rules
                if (severity is None or r.severity == severity)
                and (rule_ids is None or r.id in rule_ids)]


def load_spec(path: str) -> Spec:
    """Spec from a YAML/JSON file; a missing file means no rules."""
    import os
    if not os.path.exists(path):
        return Spec(None, None, [])
    with open(path, encoding="utf-8") as fh:
        text = fh.read()
    try:
        import yaml
        data = yaml.safe_load(text)
    except ImportError:  # pragma: no cover
        import json
        data = json.loads(text)
    return Spec.from_dict(data)


def mask_name(rule_id: str) -> str:
    return f"__m_{rule_id}"


RefResolver = Callable[[str], DataFrame] | Mapping[str, DataFrame] | None


def _resolve(refs: RefResolver, name: str, rule_id: str) -> DataFrame:
    if refs is None:
        raise ValueError(f"rule {rule_id!r} needs a table resolver for foreign_key lookup")
    return refs[name] if isinstance(refs, Mapping) else refs(name)


@dataclass
class Compiled:
    frame: DataFrame          # input columns + one boolean mask column per rule
    rules: list[Rule]
    columns: list[str]        # the input's columns, in order

    def mask(self, rule_id: str) -> Column:
        return F.col(mask_name(rule_id))

    def any_failed(self, rules: Sequence[Rule] | None = None) -> Column:
        rs = self.rules if rules is None else list(rules)
        if not rs:
            return F.lit(False)
        out = self.mask(rs[0].id)
        for r in rs[1:]:
            out = out | self.mask(r.id)
        return out

    def reason(self, rules: Sequence[Rule] | None = None, sep: str = ";") -> Column:
        """Violated rule ids joined in rule order (``''`` when none)."""
        rs = self.rules if rules is None else list(rules)
        return F.concat_ws(sep, *[F.when(self.mask(r.id), F.lit(r.id)) for r in rs]) if rs else F.lit("")

    def data(self) -> DataFrame:
        return self.frame.select(*[F.col(c) for c in self.columns])


def _base_mask(rule: Rule) -> Column:
    c = F.col(rule.columns[0]) if rule.columns else None
    if rule.type == "not_null":
        return c.isNull()
    if rule.type == "allowed_values":
        return c.isNotNull() & ~c.isin(list(rule.values or ()))
    if rule.type == "range":
        checks = []
        if rule.min is not None:
            checks.append(c < F.lit(rule.min))
        if rule.max is not None:
            checks.append(c > F.lit(rule.max))
        if not checks:
            raise ValueError(f"range rule {rule.id!r} needs min and/or max")
        out = checks[0]
        for x in checks[1:]:
            out = out | x
        return c.isNotNull() & out
    if rule.type == "fail_when":
        return F.expr(rule.expr)
    raise ValueError(f"unknown rule type {rule.type!r} in rule {rule.id!r}")


def compile_rules(df: DataFrame, rules: Sequence[Rule | Mapping], refs: RefResolver = None,
                  universe: DataFrame | None = None) -> Compiled:
    """Every rule as a mask column of ``df``. ``universe`` holds the rows among
    which ``unique`` counts, if ``df`` is only a part of them."""
    rules = [r if isinstance(r, Rule) else Rule.from_dict(r) for r in rules]
    cols = list(df.columns)
    frame = df
    masks: dict[str, Column] = {}

    # unique: one grouped count per distinct column set, joined back null-safely
    dup_marker: dict[tuple[str, ...], str] = {}
    for i, r in enumerate(x for x in rules if x.type == "unique"):
        key = tuple(r.columns)
        if key in dup_marker:
            continue
        marker = f"__dup_{len(dup_marker)}"
        dup_marker[key] = marker
        aliases = [f"__dk_{len(dup_marker)}_{j}" for j in range(len(key))]
        dups = ((frame if universe is None else universe).groupBy(*[F.col(k).alias(a) for k, a in zip(key, aliases)])
                .agg(F.count(F.lit(1)).alias("__n"))
                .where(F.col("__n") > 1)
                .select(*aliases, F.lit(True).alias(marker)))
        cond = None
        for k, a in zip(key, aliases):
            e = frame[k].eqNullSafe(dups[a])
            cond = e if cond is None else cond & e
        frame = frame.join(dups, cond, "left").drop(*aliases)

    # foreign_key: left join to the parent's distinct non-null keys
    for j, r in enumerate(x for x in rules if x.type == "foreign_key"):
        ref_name = r.ref or ""
        parent = _resolve(refs, ref_name, r.id)
        pk = f"__pk_{j}"
        marker = f"__fk_{j}"
        keys = (parent.select(F.col(r.ref_column).alias(pk)).where(F.col(pk).isNotNull())
                .distinct().withColumn(marker, F.lit(True)))
        frame = frame.join(keys, frame[r.columns[0]] == keys[pk], "left").drop(pk)
        masks[r.id] = F.col(r.columns[0]).isNotNull() & F.col(marker).isNull()

    for r in rules:
        if r.type == "unique":
            masks[r.id] = F.col(dup_marker[tuple(r.columns)]).isNotNull()
        elif r.type != "foreign_key":
            masks[r.id] = _base_mask(r)

    frame = frame.select(*[F.col(c) for c in cols],
                         *[F.coalesce(masks[r.id], F.lit(False)).alias(mask_name(r.id)) for r in rules])
    return Compiled(frame=frame, rules=rules, columns=cols)


def report(compiled: Compiled, table: str) -> DataFrame:
    """One row per rule: failed/total counts from a single aggregate pass."""
    rules = compiled.rules
    if not rules:
        spark = compiled.frame.sparkSession
        return spark.createDataFrame([], REPORT_SCHEMA)
    aggs = [F.count(F.lit(1)).alias("__total")] + [
        F.count_if(compiled.mask(r.id)).alias(f"__f{i}") for i, r in enumerate(rules)]
    one = compiled.frame.agg(*aggs)
    rows = []
    for i, r in enumerate(rules):
        rows.append(F.struct(
            F.lit(table).alias("table"), F.lit(i).cast("int").alias("rule_order"),
            F.lit(r.id).alias("rule_id"), F.lit(r.type).alias("rule_type"),
            F.lit(r.column_label).cast("string").alias("column"), F.lit(r.severity).alias("severity"),
            F.col(f"__f{i}").alias("failed_rows"), F.col("__total").alias("total_rows")))
    return (one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
            .withColumn("failed", F.col("failed_rows") > 0))


REPORT_SCHEMA = ("table string, rule_order int, rule_id string, rule_type string, column string, "
                 "severity string, failed_rows long, total_rows long, failed boolean")


def passed(report_df: DataFrame) -> Column:
    """Aggregate: true iff no error-severity rule failed."""
    return ~F.coalesce(F.max(F.when(F.col("severity") == "error", F.col("failed"))), F.lit(False))


def samples(compiled: Compiled, order_by: Sequence[str], n: int = 5,
            columns: Sequence[str] | None = None) -> DataFrame:
    """Up to ``n`` failing rows per rule, first by ``order_by`` (make it total).

    Rows are exploded into (rule_id, row) once; ``row_number() <= n`` per rule
    is planned with a map-side WindowGroupLimit, so a rule failing on a third of
    the table still ships only ``n`` rows per map task to the final ranking.
    """
    cols = list(columns or compiled.columns)
    failing = F.filter(F.array(*[F.when(compiled.mask(r.id), F.lit(r.id)) for r in compiled.rules]),
                       lambda x: x.isNotNull())
    ex = (compiled.frame.where(compiled.any_failed())
          .select(F.explode(failing).alias("rule_id"), *[F.col(c) for c in cols]))
    w = Window.partitionBy("rule_id").orderBy(*[F.col(c).asc_nulls_first() for c in order_by])
    return (ex.withColumn("sample_rank", F.row_number().over(w))
            .where(F.col("sample_rank") <= n))


def samples_nested(compiled: Compiled, order_by: Sequence[str], n: int = 5,
                   columns: Sequence[str] | None = None) -> DataFrame:
    """The same samples as one ``array<struct>`` per rule (at most ``n`` each)."""
    cols = list(columns or compiled.columns)
    s = samples(compiled, order_by, n, cols)
    return s.groupBy("rule_id").agg(
        F.sort_array(F.collect_list(F.struct(F.col("sample_rank"), *[F.col(c) for c in cols])))
        .alias("sample"))
