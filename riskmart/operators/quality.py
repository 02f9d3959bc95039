"""Declarative data checks.

``check(df, rules)`` returns one row per rule. All row-level rules of a table fold into a single
aggregation over a single scan, however many there are; that of a table with a reference groups by the
child key and serves the reference too. Uniqueness needs a shuffle of its own, on the key column alone.
"""

from __future__ import annotations

from collections import ChainMap
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.functions.scalars import count_where, round_half_up

ERROR, WARN = "error", "warn"
ROW_KINDS = ("not_null", "accepted_values", "expression", "between", "length_between")
TABLE_KINDS = ("row_count", "mean_between", "median_between")


@dataclass(frozen=True)
class Rule:
    """One check.

    kind and params:
      not_null; unique; accepted_values(values); expression(op, value); between(low, high, mostly);
      length_between(low, high); relationships(to, field); row_count(low, high);
      mean_between(low, high); median_between(low, high)
    """

    table: str
    column: str
    kind: str
    severity: str = ERROR
    params: Mapping[str, Any] = field(default_factory=dict)

    @property
    def rule_id(self) -> str:
        return f"{self.table}.{self.column}.{self.kind}"


def _literal(value) -> str:
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(value)


def _outside(text: str, params: Mapping[str, Any]) -> str:
    """SQL condition for a value beyond one of its bounds; an open bound is None or absent."""
    low, high = params.get("low"), params.get("high")
    parts = [f"{text} < {low}"] if low is not None else []
    parts += [f"{text} > {high}"] if high is not None else []
    return " OR ".join(parts) or "false"


def violation(rule: Rule) -> str:
    """SQL condition of the rows that break a row-level rule; NULL values only break ``not_null``."""
    c, p = f"`{rule.column}`", rule.params
    if rule.kind == "not_null":
        return f"{c} IS NULL"
    if rule.kind == "accepted_values":
        return f"{c} NOT IN ({', '.join(map(_literal, p['values']))})"
    if rule.kind == "expression":
        return f"NOT ({c} {p['op']} {p['value']})"
    if rule.kind == "between":
        return _outside(c, p)
    if rule.kind == "length_between":
        return _outside(f"length({c})", p)
    raise ValueError(f"{rule.kind} is no row-level rule")


def _result_row(rule: Rule, failed: str, total: str, observed: str, passed: str) -> str:
    named = {"rule_id": _literal(rule.rule_id), "column": _literal(rule.column), "kind": _literal(rule.kind),
             "severity": _literal(rule.severity), "failed": f"bigint({failed})", "total": f"bigint({total})",
             "observed": f"double({observed})", "passed": passed}
    return "named_struct(" + ", ".join(f"'{k}', {v}" for k, v in named.items()) + ")"


def _row_level(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """All rules as one aggregate row, then one output row per rule."""
    aggs, rows = ["count(1) AS _n"], []
    medians = [r for r in rules if r.kind == "median_between"]
    for i, rule in enumerate(r for r in rules if r.kind != "median_between"):
        p = rule.params
        if rule.kind in ROW_KINDS and "mostly" in p:
            aggs += [f"count_if({violation(rule)}) AS f{i}", f"count(`{rule.column}`) AS k{i}"]
            share = f"coalesce((k{i} - f{i}) / nullif(double(k{i}), 0), 1D)"
            rows.append(_result_row(rule, f"f{i}", f"k{i}", f"round({share}, 6)", f"{share} >= {p['mostly']}"))
        elif rule.kind in ROW_KINDS:
            aggs.append(f"count_if({violation(rule)}) AS f{i}")
            rows.append(_result_row(rule, f"f{i}", "_n", "NULL", f"f{i} = 0"))
        elif rule.kind == "row_count":
            rows.append(_result_row(rule, "0", "_n", "_n", f"NOT ({_outside('_n', p)})"))
        elif rule.kind == "mean_between":
            aggs.append(f"avg(`{rule.column}`) AS m{i}")
            rows.append(_result_row(rule, "0", "_n", f"round(round(m{i}, 12), 6)", f"coalesce(NOT ({_outside(f'm{i}', p)}), false)"))
        else:
            raise ValueError(rule.kind)
    out = None
    if rows:
        out = df.agg(*map(F.expr, aggs)).selectExpr(f"explode(array({', '.join(rows)})) AS r").select("r.*")
    for rule in medians:
        part = _median(df, rule)
        out = part if out is None else out.unionByName(part)
    return out


def _median(df: DataFrame, rule: Rule) -> DataFrame:
    """Median by counting equal values; the values checked this way (ages) have few distinct ones."""
    from riskmart.operators.ranking import exact_quantiles

    middle = exact_quantiles(df, rule.column, [0.5]).agg(F.max("value")).scalar()
    row = _result_row(rule, "0", "_n", "round(round(m, 12), 6)", f"coalesce(NOT ({_outside('m', rule.params)}), false)")
    return df.agg(F.count(F.lit(1)).alias("_n")).withColumn("m", middle).selectExpr(f"{row} AS r").select("r.*")


def duplicated_values(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def _unique(df: DataFrame, rule: Rule) -> DataFrame:
    per_value = df.groupBy(rule.column).agg(F.count(F.lit(1)).alias("copies"))
    counts = per_value.selectExpr(f"count_if(copies > 1 AND `{rule.column}` IS NOT NULL) AS f", "coalesce(sum(copies), 0) AS n")
    return counts.selectExpr(f"{_result_row(rule, 'f', 'n', 'NULL', 'f = 0')} AS r").select("r.*")


def _relationship(df: DataFrame, rule: Rule, parents: Mapping[str, DataFrame]) -> DataFrame:
    """Child keys are counted before the join, so a key held by most rows is one row in it."""
    parent = parents[rule.params["to"]].select(F.col(rule.params["field"]).alias("_key"))
    keys = df.groupBy(rule.column).agg(F.count(F.lit(1)).alias("copies"))
    matched = keys.join(parent.distinct().withColumn("_known", F.lit(True)), F.col(rule.column) == F.col("_key"), "left")
    lost = f"`{rule.column}` IS NOT NULL AND _known IS NULL"
    counts = matched.selectExpr(f"coalesce(sum(if({lost}, copies, 0)), 0) AS f", "coalesce(sum(copies), 0) AS n")
    return counts.selectExpr(f"{_result_row(rule, 'f', 'n', 'NULL', 'f = 0')} AS r").select("r.*")


def _with_reference(df: DataFrame, rules: Sequence[Rule], reference: Rule, parents: Mapping[str, DataFrame]) -> DataFrame:
    """Row-level rules and a reference in one pass: what breaks a rule is counted per child key, then added up."""
    parent = parents[reference.params["to"]].select(F.col(reference.params["field"]).alias("_key"))
    counts = [f"count_if({violation(r)}) AS f{i}" for i, r in enumerate(rules)]
    keys = df.groupBy(reference.column).agg(*map(F.expr, ["count(1) AS copies", *counts]))
    matched = keys.join(parent.distinct().withColumn("_known", F.lit(True)), F.col(reference.column) == F.col("_key"), "left")
    lost = f"`{reference.column}` IS NOT NULL AND _known IS NULL"
    sums = [f"coalesce(sum(f{i}), 0) AS f{i}" for i in range(len(rules))]
    total = matched.selectExpr(f"coalesce(sum(if({lost}, copies, 0)), 0) AS f", "coalesce(sum(copies), 0) AS n", *sums)
    rows = [_result_row(r, f"f{i}", "n", "NULL", f"f{i} = 0") for i, r in enumerate(rules)]
    rows.append(_result_row(reference, "f", "n", "NULL", "f = 0"))
    return total.selectExpr(f"explode(array({', '.join(rows)})) AS r").select("r.*")


def check(df: DataFrame, rules: Sequence[Rule], parents: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Result rows of the rules of one table."""
    folded = [r for r in rules if r.kind in ROW_KINDS + TABLE_KINDS]
    references = [r for r in rules if r.kind == "relationships"]
    parts = []
    if references and folded and all(r.kind in ROW_KINDS and "mostly" not in r.params for r in folded):
        parts.append(_with_reference(df, folded, references.pop(0), parents or {}))
    elif folded:
        parts.append(_row_level(df, folded))
    parts += [_unique(df, r) for r in rules if r.kind == "unique"]
    parts += [_relationship(df, r, parents or {}) for r in references]
    return reduce(DataFrame.unionByName, parts)


def check_all(tables: Mapping[str, DataFrame], rules: Sequence[Rule],
              parents: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Result rows of a whole rule set, table by table; ``parents`` are looked up before ``tables``."""
    known = tables if parents is None else ChainMap(parents, tables)
    names = list(dict.fromkeys(r.table for r in rules))
    return reduce(DataFrame.unionByName, [check(tables[n], [r for r in rules if r.table == n], known) for n in names])


def suite_report(results: DataFrame) -> DataFrame:
    """Rules, passes, failures by severity and the failed rule names."""
    bad = ~F.col("passed")
    return results.agg(
        F.count(F.lit(1)).alias("rules"), count_where(F.col("passed")).alias("passed"), count_where(bad).alias("failed"),
        count_where(bad & (F.col("severity") == ERROR)).alias("failed_errors"),
        F.array_join(F.array_sort(F.collect_list(F.when(bad, F.col("rule_id")))), ",").alias("failed_rules"))


class DataQualityError(RuntimeError):
    pass


def require_passed(results: DataFrame) -> None:
    """Raise when a rule of severity error failed; warnings do not stop the run."""
    broken = results.filter((~F.col("passed")) & (F.col("severity") == ERROR)).orderBy("rule_id").collect()
    if broken:
        raise DataQualityError("; ".join(f"{r.rule_id}: failed={r.failed} observed={r.observed}" for r in broken))


# --- domain alert ----------------------------------------------------------------------------------

def alert_predicates(strict: bool = True) -> dict[str, Column]:
    """Row conditions that must not occur; unknown values do not raise the alert.

    The tolerant set leaves out the two set-membership conditions.
    """
    score = F.col("composite_risk_score")
    preds = {
        "negative_ratio": F.col("credit_to_income_ratio") < 0,
        "delinquency_above_one": F.col("bureau_delinquency_rate") > 1,
        "late_rate_above_one": F.col("inst_late_rate") > 1,
        "score_above_one": score > 1,
        "score_below_zero": score < 0,
    }
    if strict:
        preds["flag_domain"] = ~F.col("default_flag").isin(0, 1)
        preds["segment_domain"] = ~F.col("credit_risk_segment").isin("LOW", "MEDIUM", "HIGH", "VERY_HIGH")
    return preds


def domain_violations(fact: DataFrame, strict: bool = True) -> DataFrame:
    """Violating rows with the names of the broken conditions."""
    preds = alert_predicates(strict)
    broken = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in preds.items()]))
    return fact.withColumn("broken", broken).filter(F.size("broken") > 0)


def alert_raised(fact: DataFrame, strict: bool = True) -> bool:
    """Whether any row violates; the scan stops at the first one found."""
    anything = reduce(lambda a, b: a | b, alert_predicates(strict).values())
    return not fact.filter(anything).limit(1).isEmpty()


# --- freshness and gates ---------------------------------------------------------------------------

def freshness(tables: Mapping[str, DataFrame], warn_after_days: Mapping[str, int], now: str,
              column: str = "loaded_at") -> DataFrame:
    """Age of the newest row per table against its limit."""
    parts = []
    for name, days in warn_after_days.items():
        newest = tables[name].agg(F.max(column).alias("newest"))
        age = (F.unix_timestamp(F.lit(now).cast("timestamp")) - F.unix_timestamp(F.col("newest").cast("timestamp"))) / F.lit(86400.0)
        parts.append(newest.select(
            F.lit(name).alias("source"), F.date_format("newest", "yyyy-MM-dd HH:mm:ss").alias("newest"),
            round_half_up(age, 4).alias("age_days"), F.coalesce(age > days, F.lit(True)).alias("stale")))
    return reduce(DataFrame.unionByName, parts)


def row_count_gate(df: DataFrame, at_least: int) -> bool:
    """Whether the table has enough rows. Counts are combined per task; nothing else is moved."""
    row = df.agg(F.count(F.lit(1)).alias("n")).first()
    return (row["n"] if row else 0) >= at_least


class RowCountError(RuntimeError):
    pass


def require_rows(df: DataFrame, at_least: int, name: str = "table") -> None:
    n = df.count()
    if n < at_least:
        raise RowCountError(f"{name}: {n} rows, at least {at_least} needed")


# --- record validation -----------------------------------------------------------------------------

def with_reasons(df: DataFrame, bounds: Mapping[str, tuple]) -> DataFrame:
    """Add the list of broken field rules; an absent optional field is fine and takes its default."""
    checks = []
    for name, (default, low, high) in bounds.items():
        c = F.col(name)
        if default is None:
            checks.append(F.when(c.isNull(), F.lit(f"{name}: missing")))
        if low is not None:
            checks.append(F.when(c < low, F.lit(f"{name}: below {low}")))
        if high is not None:
            checks.append(F.when(c > high, F.lit(f"{name}: above {high}")))
    return df.withColumn("reasons", F.array_compact(F.array(*checks)))


def validate_records(df: DataFrame, bounds: Mapping[str, tuple]) -> tuple[DataFrame, DataFrame]:
    """(valid rows with defaults filled in, rejected rows with reasons)."""
    judged = with_reasons(df, bounds)
    filled = {n: F.coalesce(F.col(n), F.lit(d)) for n, (d, _, _) in bounds.items() if d is not None}
    valid = judged.filter(F.size("reasons") == 0).drop("reasons").withColumns(filled)
    return valid, judged.filter(F.size("reasons") > 0)
