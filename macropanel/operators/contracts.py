"""Data contracts (Q1-Q5): every rule is a count of violating rows, and the rows themselves on demand.

A contract check is one or two aggregations over the artifact and yields a
violations DataFrame ``(artifact, rule, column, n)`` with one row per rule,
zero counts included; ``enforce`` raises once, listing every failed rule
(collect-all mode), before anything is written. The failing rows, with their
key and the value that failed, are then in a table of the checkpoint folder
that the error names; the driver gets counts only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from macropanel.model import DATA_CARD_SCHEMA, DATE, K, PANEL, SERIES, VALUE
from macropanel.session import write_faults

#: Failures of an input that an error lists: a row per rule, and one per panel that lacks cells.
SHOWN = 1000

CONTRACTS = ("raw", "transformed", "imputed", "mask", "data_card")


class ContractError(ValueError):
    """``failures`` has the counts; ``table`` is the path of the failing rows, if there are any."""

    def __init__(self, failures: list[tuple[str, str, str, int]], table: str | None = None):
        self.failures, self.table = failures, table
        lines = [f"{a}: {r} on {c} ({n} rows)" for a, r, c, n in failures]
        super().__init__("contract violations:\n" + "\n".join(lines) + (f"\nfailing rows: {table}" if table else ""))


def _schema_rules(df: DataFrame, artifact: str, required: dict[str, T.DataType], strict: list[str] | None = None) -> list[tuple[str, str, int]]:
    """Static checks on the driver: required column types, and exact column set if strict."""
    out = []
    types = {f.name: f.dataType for f in df.schema.fields}
    for name, dtype in required.items():
        ok = name in types and types[name] == dtype
        out.append(("dtype", name, 0 if ok else 1))
    if strict is not None:
        out.append(("strict_columns", "*", 0 if sorted(types) == sorted(strict) else 1))
    return out


def _counts(df: DataFrame, rules: list[tuple[str, str, Column]]) -> list[Column]:
    return [F.count_if(cond).cast("long").alias(f"{rule}|{col}") for rule, col, cond in rules]


def _static(df: DataFrame, contract: str) -> list[tuple[str, str, int]]:
    if contract in ("raw", "transformed", "imputed"):
        return _schema_rules(df, contract, {DATE: T.DateType(), VALUE: T.DoubleType()})
    if contract == "mask":
        return _schema_rules(df, contract, {DATE: T.DateType(), "imputed": T.BooleanType()})
    if contract == "data_card":
        fields = DATA_CARD_SCHEMA.fields
        return _schema_rules(df, contract, {f.name: f.dataType for f in fields}, [f.name for f in fields])
    raise ValueError(f"unknown contract: {contract}")


def violations(df: DataFrame, contract: str) -> DataFrame:
    """Schema rules (checked on the driver) plus value rules (one lazy DataFrame)."""
    static = [(contract, r, c, n) for r, c, n in _static(df, contract)]
    head = df.sparkSession.createDataFrame(static, "artifact string, rule string, column string, n long")
    return head.unionByName(violations_sql_part(df, contract))


def _value_rules(contract: str) -> tuple[list[tuple[str, str, Column]], list[str]]:
    """(rule, column, condition of a failure) of a contract, and the key that must be unique."""
    if contract in ("raw", "transformed", "imputed"):
        rules = [("not_null", DATE, F.col(DATE).isNull()), ("not_null", SERIES, F.col(SERIES).isNull())]
        if contract == "imputed":  # nothing is missing after imputation
            rules.append(("not_null", VALUE, F.col(VALUE).isNull() | F.isnan(VALUE)))
        return rules, K + [DATE]
    if contract == "mask":
        return [("not_null", DATE, F.col(DATE).isNull()), ("not_null", "imputed", F.col("imputed").isNull())], K + [DATE]
    if contract == "data_card":
        rules = [("not_null", SERIES, F.col(SERIES).isNull()), ("not_null", "kept", F.col("kept").isNull())]
        for c in ("n_obs", "n_missing_leading", "n_missing_internal"):
            rules += [("not_null", c, F.col(c).isNull()), ("ge_0", c, F.col(c) < 0)]
        for c in ("frac_missing", "frac_missing_leading", "frac_missing_internal"):
            rules += [("not_null", c, F.col(c).isNull()), ("in_0_1", c, (F.col(c) < 0) | (F.col(c) > 1))]
        return rules, K
    raise ValueError(f"unknown contract: {contract}")


def violations_sql_part(df: DataFrame, contract: str) -> DataFrame:
    """The value-level rules only, as one lazy DataFrame (no driver round trip)."""
    rules, keys = _value_rules(contract)
    rules = [r for r in rules if r[1] in df.columns]  # an absent column is reported by the dtype rule
    counts = df.agg(*_counts(df, rules))
    stacked = counts.select(
        F.explode(
            F.array(*[F.struct(F.lit(rule).alias("rule"), F.lit(col).alias("column"), F.col(f"`{rule}|{col}`").alias("n")) for rule, col, _ in rules])
        ).alias("v")
    ).select(F.lit(contract).alias("artifact"), "v.rule", "v.column", "v.n")
    dups = (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_c"))
        .agg(F.coalesce(F.sum(F.when(F.col("_c") > 1, F.col("_c") - 1)), F.lit(0)).cast("long").alias("n"))
        .select(F.lit(contract).alias("artifact"), F.lit("unique").alias("rule"), F.lit("+".join(keys[1:])).alias("column"), "n")
    )
    return stacked.unionByName(dups)


FAILURES = "artifact string, rule string, column string, panel_id string, series_id string, date date, value string, n long"


def failures(df: DataFrame, contract: str) -> DataFrame:
    """The failing rows of a contract's value rules: artifact, rule, column, panel_id, series_id, date, value, n.

    One pass writes a row per rule that a row fails, with the value as text (null where that is the failure); keys that
    stand several times are a row each, ``n`` telling how many rows are too many (1 for the other rules). Counting
    ``n`` by rule gives ``violations``. A contract without a date has none here.
    """
    rules, keys = _value_rules(contract)
    rules = [r for r in rules if r[1] in df.columns]
    date = F.col(DATE) if DATE in keys else F.lit(None).cast("date")
    key = [F.col(PANEL).cast("string").alias(PANEL), F.col(SERIES).cast("string").alias(SERIES), date.alias(DATE)]
    failed = [F.when(cond, F.struct(F.lit(rule).alias("rule"), F.lit(col).alias("column"), F.col(col).cast("string").alias("value"))) for rule, col, cond in rules]
    found = df.select(*key, F.explode(F.filter(F.array(*failed), lambda x: x.isNotNull())).alias("f"))
    found = found.select(F.lit(contract).alias("artifact"), "f.rule", "f.column", PANEL, SERIES, DATE, "f.value", F.lit(1).cast("long").alias("n"))
    twice = df.groupBy(*keys).agg((F.count(F.lit(1)) - 1).alias("n")).where("n > 0")
    twice = twice.select(F.lit(contract).alias("artifact"), F.lit("unique").alias("rule"), F.lit("+".join(keys[1:])).alias("column"), *key, F.lit(None).cast("string").alias("value"), "n")
    return found.unionByName(twice)


def all_failures(artifacts: dict[str, DataFrame], contracts: dict[str, str] | None = None) -> DataFrame:
    """The failing rows of several artifacts (name -> DF; the contract is named alike unless given)."""
    of = contracts or {}
    return reduce(DataFrame.unionByName, [failures(df, of.get(c, c)).withColumn("artifact", F.lit(c)) for c, df in artifacts.items()])


def density_violations(panel: DataFrame) -> DataFrame:
    """Rows (artifact, rule, column, n): cells that a panel's (series, date) grid lacks, per panel.

    A panel is dense if each of its series has a cell at each of its dates; the lags and the slice of the
    transforms, and the row vectors of the imputation, count on that.
    """
    cells = panel.select(PANEL, SERIES, DATE).distinct()
    size = cells.groupBy(PANEL).agg(F.count(F.lit(1)).alias("cells"), F.countDistinct(DATE).alias("dates"), F.countDistinct(SERIES).alias("ids"))
    lack = size.select(F.coalesce(PANEL, F.lit("")).alias(PANEL), (F.col("dates") * F.col("ids") - F.col("cells")).alias("n")).where("n > 0")
    return lack.select(F.lit("input").alias("artifact"), F.lit("dense").alias("rule"), F.concat(F.lit("cells of panel "), PANEL).alias("column"), "n")


def check_input(panel: DataFrame) -> None:
    """The panel as it comes in: keys, types and density, before anything is computed from it."""
    found = [("input", r, c, n) for _, r, c, n in [("raw", *x) for x in _static(panel, "raw")] if n > 0]
    if not found:
        counts = violations_sql_part(panel, "raw").where("n > 0").withColumn("artifact", F.lit("input"))
        named = panel.agg(F.count_if(F.col(PANEL).isNull()).alias("n")).select(F.lit("input").alias("artifact"), F.lit("not_null").alias("rule"), F.lit(PANEL).alias("column"), "n").where("n > 0")
        found = [tuple(r) for r in counts.unionByName(named).unionByName(density_violations(panel)).limit(SHOWN).collect()]
    if found:
        raise ContractError(found)


def all_violations(artifacts: dict[str, DataFrame], contracts: dict[str, str] | None = None) -> DataFrame:
    """Union of the value-level rule counts of several artifacts (name -> DF; the contract is named alike unless given)."""
    of = contracts or {}
    return reduce(DataFrame.unionByName, [violations_sql_part(df, of.get(c, c)).withColumn("artifact", F.lit(c)) for c, df in artifacts.items()])


def enforce(artifacts: dict[str, DataFrame], contracts: dict[str, str] | None = None) -> None:
    """Check every artifact (schema on the driver, values in one job); raise once listing all failures."""
    of = contracts or {}
    typed = [(c, r, col, n) for c, df in artifacts.items() for r, col, n in _static(df, of.get(c, c)) if n > 0]
    counted = [tuple(r) for r in all_violations(artifacts, of).where("n > 0").collect()]
    if counted or typed:
        named = {c: df for c, df in artifacts.items() if any(x[0] == c for x in counted)}
        raise ContractError(typed + counted, write_faults(all_failures(named, of), "contract-failures") if named else None)
