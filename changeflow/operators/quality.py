"""Source-table constraints as a data-quality report (TBL-9) and defaults (TBL-10)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.schemas import DEFAULT_STATUS, STATUS_VALUES


@dataclass(frozen=True)
class Constraint:
    rule: str  # not_null | unique | domain | max_length | decimal
    column: str
    arg: object = None


# The source table's declared constraints.
SHIPMENT_CONSTRAINTS = [
    *[Constraint("not_null", c) for c in ("tracking_id", "shipper_name", "shipper_city", "customer_name",
                                           "customer_city", "weight_kg", "status")],
    Constraint("unique", "tracking_id"),
    Constraint("domain", "status", tuple(STATUS_VALUES)),
    Constraint("max_length", "tracking_id", 20),
    Constraint("max_length", "shipper_name", 100),
    Constraint("max_length", "shipper_city", 50),
    Constraint("max_length", "customer_name", 100),
    Constraint("max_length", "customer_city", 50),
    Constraint("max_length", "current_location", 100),
    Constraint("decimal", "weight_kg", (6, 2)),
]


def _check(c: Constraint) -> Column:
    x = F.col(c.column)
    if c.rule == "not_null":
        return x.isNull()
    if c.rule == "domain":
        return x.isNotNull() & ~x.isin(*c.arg)
    if c.rule == "max_length":
        return x.isNotNull() & (F.length(x) > c.arg)
    if c.rule == "decimal":
        p, s = c.arg
        d = F.expr(f"try_cast({c.column} AS DECIMAL(38, {s + 4}))")
        fits = F.expr(f"try_cast({c.column} AS DECIMAL({p}, {s}))")
        return x.isNotNull() & (d.isNull() | fits.isNull() | (d != fits))
    raise ValueError(c.rule)


def violations(df: DataFrame, key: str, rules: list[Constraint] = SHIPMENT_CONSTRAINTS) -> DataFrame:
    """One row per (row key, rule, column) that breaks a constraint.

    One ``when`` per rule, exploded together. A UNIQUE rule joins the values
    that occur more than once: their counts are partially aggregated, and the
    join's large side can be split, so a heavily duplicated value is not one
    task's work.
    """
    rows = df
    for c in (c for c in rules if c.rule == "unique"):
        often = df.groupBy(c.column).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
        rows = rows.join(often.select(c.column, F.lit(True).alias(f"_dup_{c.column}")), c.column, "left")
    tags = F.array_compact(F.array(*[
        F.when(F.col(f"_dup_{c.column}") if c.rule == "unique" else _check(c), F.struct(F.lit(c.rule).alias("rule"), F.lit(c.column).alias("column")))
        for c in rules]))
    return rows.select(F.col(key).alias("row_key"), F.explode(tags).alias("v")).select("row_key", "v.rule", "v.column")


def apply_defaults(df: DataFrame, now: Column) -> DataFrame:
    """TBL-10: status defaults to PICKED_UP; created/updated default to ``now``."""
    out = df.withColumn("status", F.coalesce(F.col("status"), F.lit(DEFAULT_STATUS)))
    for c in ("created_at", "updated_at"):
        out = out.withColumn(c, F.coalesce(F.col(c), now) if c in df.columns else now)
    return out
