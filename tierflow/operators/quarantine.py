"""Quarantine split, rule policies and foreign-key cascades.

The split tags each row with the ids of the error rules it violates
(``_reject_reason``, rule order, ``;``-joined) and separates good from bad
with one mask column, so both sides come from the same compiled frame.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.operators.rules import Compiled, Rule, compile_rules

ACTIONS = ("quarantine", "warn_and_keep", "block")


class QualityBlocked(RuntimeError):
    """A rule with action ``block`` failed: the run must stop."""


def quarantine_rules(rules: Sequence[Rule], rule_ids: Sequence[str] | None = None) -> list[Rule]:
    """Error-severity rules, optionally limited to ``rule_ids``."""
    return [r for r in rules if r.severity == "error" and (rule_ids is None or r.id in rule_ids)]


def split(compiled: Compiled, rule_ids: Sequence[str] | None = None,
          quarantined_at: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(good, bad) frames. ``bad`` carries ``_reject_reason`` and ``_quarantined_at``."""
    rs = quarantine_rules(compiled.rules, rule_ids)
    flag = compiled.any_failed(rs)
    data_cols = [F.col(c) for c in compiled.columns]
    good = compiled.frame.where(~flag).select(*data_cols)
    ts = quarantined_at if quarantined_at is not None else F.localtimestamp()
    bad = compiled.frame.where(flag).select(
        *data_cols, compiled.reason(rs).alias("_reject_reason"),
        ts.cast("timestamp_ntz").alias("_quarantined_at"))
    return good, bad


def tag_layers(compiled: Compiled, rule_ids: Sequence[str] | None = None) -> DataFrame:
    """Every row once, with ``_layer`` = silver|quarantine and its reason
    (null for good rows): the split as one frame, good ∪ bad = input."""
    rs = quarantine_rules(compiled.rules, rule_ids)
    flag = compiled.any_failed(rs)
    return compiled.frame.select(
        *[F.col(c) for c in compiled.columns],
        F.when(flag, F.lit("quarantine")).otherwise(F.lit("silver")).alias("_layer"),
        F.when(flag, compiled.reason(rs)).alias("_reject_reason"))


def decide(report_df: DataFrame, policy: Mapping[str, str] | DataFrame | None,
           default: str = "quarantine") -> DataFrame:
    """Join failed error-rule findings to a (rule_id -> action) policy.

    Rules absent from the policy get ``default`` (the deterministic policy:
    quarantine every error-severity failure)."""
    findings = report_df.where(F.col("failed") & (F.col("severity") == "error"))
    if policy is None:
        return findings.withColumn("action", F.lit(default))
    if isinstance(policy, Mapping):
        bad = [a for a in policy.values() if a not in ACTIONS]
        if bad:
            raise ValueError(f"unknown actions {bad}; expected one of {ACTIONS}")
        pairs = [F.struct(F.lit(k).alias("p_rule_id"), F.lit(v).alias("p_action")) for k, v in policy.items()]
        pol = report_df.sparkSession.range(1).select(F.explode(F.array(*pairs)).alias("p")).select("p.*") \
            if pairs else report_df.sparkSession.createDataFrame([], "p_rule_id string, p_action string")
        pol = F.broadcast(pol)  # one row per listed rule: bounded by the mapping itself
    else:
        pol = policy.select(F.col("rule_id").alias("p_rule_id"), F.col("action").alias("p_action"))
    return (findings.join(pol, findings["rule_id"] == pol["p_rule_id"], "left")
            .withColumn("action", F.coalesce(F.col("p_action"), F.lit(default)))
            .drop("p_rule_id", "p_action"))


def cascade(tables: Sequence[tuple[str, DataFrame, Sequence[Mapping]]], refs: dict | None = None,
            stage=None) -> dict[str, DataFrame]:
    """Clean tables in dependency order (parents first).

    ``tables`` is a list of (name, frame, rules). Each table's rules may refer
    to earlier tables by name in ``foreign_key.ref``; they see the *cleaned*
    (good) parent, so quarantining a parent orphans its children. Returns
    name -> every row once, with ``_layer`` and ``_reject_reason`` (see
    :func:`tag_layers`). ``stage(name, frame)`` may write a tagged table and
    read it back, so that no child computes its parent again.
    """
    resolved: dict[str, DataFrame] = dict(refs or {})
    out: dict[str, DataFrame] = {}
    for name, df, rules in tables:
        tagged = tag_layers(compile_rules(df, rules, resolved))
        out[name] = stage(name, tagged) if stage else tagged
        resolved[name] = good_rows(out[name])
    return out


def good_rows(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col("_layer") == "silver").drop("_layer", "_reject_reason")


def bad_rows(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col("_layer") == "quarantine").drop("_layer")
