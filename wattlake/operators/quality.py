"""Declarative data-quality checks and audit rows (Q01-Q14)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake import schemas
from wattlake.operators.joins import small_side

NOT_NULL, UNIQUE = "not_null", "unique"
ACCEPTED, EXPRESSION = "accepted_values", "expression_is_true"


@dataclass(frozen=True)
class Check:
    """One assertion on a column. ``where`` narrows the rows, ``severity`` is error or warn."""

    table: str
    column: str
    kind: str
    values: tuple[str, ...] = ()
    predicate: str = ""
    where: str = ""
    severity: str = "error"
    name: str = field(init=False)

    def __post_init__(self) -> None:
        short = self.table.split(".")[-1]
        object.__setattr__(self, "name", f"{self.kind}_{short}_{self.column}")

    def scope(self) -> str:
        return f"coalesce({self.where}, false)" if self.where else "true"

    def fails(self) -> str:
        """SQL predicate of a failing row; a NULL passes every kind but not_null."""
        if self.kind == NOT_NULL:
            bad = f"{self.column} IS NULL"
        elif self.kind == ACCEPTED:
            bad = f"{self.column} NOT IN ({', '.join(text_literal(v) for v in self.values)})"
        elif self.kind == EXPRESSION:
            bad = f"NOT ({self.column} {self.predicate})"
        else:
            raise ValueError(f"{self.kind} is not a check of single rows")
        return f"{self.scope()} AND {bad}"

    def result(self, checked: str, failed: str) -> str:
        """SQL struct of the check's result row."""
        schema, table = self.table.split(".")
        labels = {
            "check_name": self.name,
            "table_schema": schema,
            "table_name": table,
            "column_name": self.column,
            "check_type": self.kind,
            "severity": self.severity,
            "scope": self.where,
        }
        texts = [f"{text_literal(v)} AS {k}" for k, v in labels.items()]
        counts = [f"{checked} AS rows_checked", f"{failed} AS rows_failed"]
        return f"struct({', '.join(texts + counts)})"


def text_literal(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def failing_rows(table: DataFrame, check: Check) -> DataFrame:
    """Rows that violate a check; for unique the repeated keys with their number."""
    if check.kind == UNIQUE:
        return (
            table.filter(check.scope())
            .filter(F.col(check.column).isNotNull())
            .groupBy(check.column)
            .agg(F.count(F.lit(1)).alias("n_records"))
            .filter("n_records > 1")
        )
    return table.filter(check.fails())


def evaluate(table: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One result row for each check of a table.

    All checks of single rows share one aggregate, that is one scan however many there are.
    A unique check groups by its key; equal keys combine before the shuffle.
    """
    results = []
    row_checks = [c for c in checks if c.kind != UNIQUE]
    if row_checks:
        scopes = {scope: f"checked_{i}" for i, scope in enumerate({c.scope(): 0 for c in row_checks})}
        counts = table.selectExpr(
            *(f"count_if({scope}) AS {name}" for scope, name in scopes.items()),
            *(f"count_if({c.fails()}) AS failed_{i}" for i, c in enumerate(row_checks)),
        )
        rows = [c.result(scopes[c.scope()], f"failed_{i}") for i, c in enumerate(row_checks)]
        results.append(counts.selectExpr(f"inline(array({', '.join(rows)}))"))
    for check in (c for c in checks if c.kind == UNIQUE):
        keys = table.filter(check.scope()).groupBy(check.column).agg(F.count(F.lit(1)).alias("n"))
        totals = keys.selectExpr(
            "coalesce(sum(n), 0) AS checked",
            f"count_if({check.column} IS NOT NULL AND n > 1) AS failed",
        )
        results.append(totals.selectExpr(f"inline(array({check.result('checked', 'failed')}))"))
    return with_status(reduce(DataFrame.unionByName, results))


def with_status(results: DataFrame) -> DataFrame:
    """The result of each check: passed, or by its severity warning or failed."""
    failed = F.col("rows_failed") > 0
    return results.withColumn(
        "check_result",
        F.when(~failed, "passed").when(F.col("severity") == "warn", "warning").otherwise("failed"),
    )


def evaluate_all(tables: Mapping[str, DataFrame], checks: Iterable[Check]) -> DataFrame:
    by_table: dict[str, list[Check]] = {}
    for check in checks:
        by_table.setdefault(check.table, []).append(check)
    parts = [evaluate(tables[name], group) for name, group in by_table.items()]
    return reduce(DataFrame.unionByName, parts)


def audit_rows(results: DataFrame, checked_at: Column | None = None) -> DataFrame:
    """Result rows in the shape of the audit table, with their failure percentage."""
    when = F.current_timestamp() if checked_at is None else checked_at
    percent = F.when(
        F.col("rows_checked") > 0, F.round(F.col("rows_failed") / F.col("rows_checked") * 100, 4)
    ).otherwise(F.lit(0.0))
    return results.select(
        "check_name",
        "table_schema",
        "table_name",
        "check_type",
        "check_result",
        "rows_checked",
        "rows_failed",
        percent.alias("failure_percentage"),
        when.cast("timestamp_ntz").alias("check_timestamp"),
        F.to_json(F.struct(F.col("column_name").alias("column"), "severity", "scope")).alias(
            "details"
        ),
    )


def freshness(
    table: DataFrame, as_of: Column, timestamp: str = "ingestion_timestamp",
    warn_hours: int = 12, error_hours: int = 24,
) -> DataFrame:
    """Age of the newest row and its status; an empty table is an error."""
    age = F.timestamp_diff("SECOND", F.max(timestamp), F.max(as_of)) / F.lit(3600.0)
    return table.agg(F.max(timestamp).alias("newest"), age.alias("age_hours")).withColumn(
        "status",
        F.when(F.col("age_hours").isNull() | (F.col("age_hours") > error_hours), "error")
        .when(F.col("age_hours") > warn_hours, "warn")
        .otherwise("pass"),
    )


def row_count_gate(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row with ``<name>_count`` columns and pass if every table has rows, else fail."""
    counts = [
        table.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n")
        for name, table in tables.items()
    ]
    wide = reduce(DataFrame.unionByName, counts).agg(
        *(F.max(F.when(F.col("name") == t, F.col("n"))).alias(f"{t}_count") for t in tables),
        F.min("n").alias("least"),
    )
    status = F.when(F.col("least") > 0, "pass").otherwise("fail")
    return wide.withColumn("status", status).drop("least")


def orphans(fact: DataFrame, dimension: DataFrame, key: str, rows: int | None = None) -> DataFrame:
    """Fact rows whose key the dimension does not have."""
    return fact.join(small_side(dimension.select(key), rows), key, "left_anti")


def seed_bounds(tables: Mapping[str, tuple[DataFrame, Column, int]]) -> DataFrame:
    """Count of each table's rows that meet a condition, against the least number wanted."""
    parts = [
        table.agg(F.count_if(condition).alias("n")).select(
            F.lit(name).alias("bound"), "n", F.lit(least).alias("at_least")
        )
        for name, (table, condition, least) in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts).withColumn(
        "status", F.when(F.col("n") >= F.col("at_least"), "pass").otherwise("fail")
    )


def missing_columns(table: DataFrame, required: Sequence[str]) -> list[str]:
    return [c for c in required if c not in table.columns]


def column_conformance(name: str, table: DataFrame, required: Sequence[str]) -> DataFrame:
    """For each required column whether the table has it, with the table's number of rows."""
    rows = [
        F.struct(
            F.lit(name).alias("table_name"),
            F.lit(c).alias("column_name"),
            F.lit(c in table.columns).alias("is_present"),
            F.col("n").alias("rows_checked"),
        )
        for c in required
    ]
    return table.agg(F.count(F.lit(1)).alias("n")).select(F.inline(F.array(*rows)))


def run_row(spark: SparkSession, **values) -> DataFrame:
    """One audit row of a finished run; fields that are not given stay NULL."""
    fields = schemas.RUN_RESULT.fieldNames()
    unknown = set(values) - set(fields)
    if unknown:
        raise ValueError(f"unknown fields of a run: {sorted(unknown)}")
    start, end = values.get("start_time"), values.get("end_time")
    if start and end and "duration_seconds" not in values:
        values["duration_seconds"] = int((end - start).total_seconds())
    return spark.createDataFrame([tuple(values.get(f) for f in fields)], schemas.RUN_RESULT)
