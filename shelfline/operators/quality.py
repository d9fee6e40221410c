"""Validation rules, the valid/reject split and the reject-rate gate (5.1-5.6, 8.5)."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from shelfline import config
from shelfline.sinks import lake as L

INVALID = "_invalid"


def require_columns(df: DataFrame, entity: str, mandatory: dict | None = None) -> None:
    """Mandatory columns present, else an error naming the missing ones (5.1)."""
    need = (mandatory or config.MANDATORY)[entity]
    missing = [c for c in need if c not in df.columns]
    if missing:
        raise ValueError(f"{entity}: mandatory columns missing {missing}")


def rule_required(cols: list[str]) -> Column:
    """Any mandatory value null -> invalid (5.2)."""
    expr = F.lit(False)
    for c in cols:
        expr = expr | F.col(c).isNull()
    return expr


def _safe(pred: Column) -> Column:
    return F.coalesce(pred, F.lit(False))


def rule_sales() -> Column:
    return _safe((F.col("quantity") <= 0) | (F.col("price") < 0))


def rule_products() -> Column:
    return _safe(F.col("price") < 0)


def rule_stock() -> Column:
    return _safe(F.col("quantity") < 0)


def rule_customers() -> Column:
    return ~F.coalesce(F.col("email"), F.lit("")).contains("@")


ENTITY_RULES = {
    "sales": rule_sales,
    "products": rule_products,
    "stock": rule_stock,
    "customers": rule_customers,
}


def invalid_flag(entity: str, mandatory: dict | None = None) -> Column:
    """Complete predicate of one entity: mandatory nulls OR its business rule."""
    need = (mandatory or config.MANDATORY)[entity]
    return rule_required(need) | ENTITY_RULES[entity]()


def tag(df: DataFrame, entity: str, mandatory: dict | None = None) -> DataFrame:
    require_columns(df, entity, mandatory)
    return df.withColumn(INVALID, invalid_flag(entity, mandatory))


def gate_stats(tagged: DataFrame) -> DataFrame:
    """One row: total, rejected, rate = rejected / max(total, 1) (8.5)."""
    n = F.count(F.lit(1))
    bad = F.count_if(F.col(INVALID))
    return tagged.agg(n.alias("n_total"), bad.alias("n_rejected"),
                      (bad / F.greatest(n, F.lit(1))).alias("reject_rate"))


@dataclass
class GateResult:
    entity: str
    n_total: int
    n_rejected: int
    rate: float
    limit: float

    @property
    def passed(self) -> bool:
        return self.rate <= self.limit


def check_gate(result: GateResult) -> None:
    if not result.passed:
        raise ValueError(f"{result.entity}: reject rate {result.rate:.1%} above the limit "
                         f"of {result.limit:.0%} ({result.n_rejected} of {result.n_total})")


def split(tagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    valid = tagged.where(~F.col(INVALID)).drop(INVALID)
    rejects = tagged.where(F.col(INVALID)).drop(INVALID)
    return valid, rejects


def validate(df: DataFrame, entity: str, limit: float | None = None,
             write_rejects=None, write_valid=None) -> tuple[DataFrame | None, GateResult]:
    """Tag, count while writing the rejects, gate, then write the valid rows: for any two sinks.

    ``write_rejects(df)`` always runs (an empty frame replaces stale rejects of a
    rerun) and its job also collects the gate counts through an observation;
    ``write_valid(df)`` runs only when the gate passes.  Each sink's job reads ``df``, so pass
    a written table; ``validate_day`` needs one job for both sides.
    """
    limit = config.reject_limit() if limit is None else limit
    tagged = tag(df, entity)
    if write_rejects is not None:
        obs = Observation(f"gate_{entity}_{uuid.uuid4().hex[:8]}")
        observed = tagged.observe(obs, F.count(F.lit(1)).alias("n_total"),
                                  F.count_if(F.col(INVALID)).alias("n_rejected"))
        write_rejects(observed.where(F.col(INVALID)).drop(INVALID))
        n_total, n_bad = int(obs.get["n_total"]), int(obs.get["n_rejected"])
    else:
        row = gate_stats(tagged).first()
        n_total, n_bad = int(row["n_total"]), int(row["n_rejected"])
    result = GateResult(entity, n_total, n_bad, n_bad / max(n_total, 1), limit)
    check_gate(result)
    valid, _ = split(tagged)
    if write_valid is not None:
        write_valid(valid)
        return None, result
    return valid, result


def validate_day(df: DataFrame, entity: str, rejects_root: str, valid_root: str, staging_root: str,
                 ds: str, limit: float | None = None) -> GateResult:
    """The gate of a day in one job (5.6): rows written once, split by their flag, then published.

    The job writes both sides under ``staging_root`` and counts them on the way.  The rejects'
    folder then takes the place of the day's rejects, whatever the gate says (a side without rows
    becomes an empty table); the valid rows' folder takes the place of the day's valid rows if
    the gate passes and is removed otherwise, so a day that fails keeps its earlier valid rows.
    """
    spark = df.sparkSession
    limit = config.reject_limit() if limit is None else limit
    tagged, obs = L.counted(tag(df, entity), n_rejected=F.count_if(F.col(INVALID)))
    staged = L.partition_dir(staging_root, ds)
    (tagged.write.mode("overwrite").option("partitionOverwriteMode", "static")
     .options(**L.PARQUET).partitionBy(INVALID).parquet(staged))
    n_total, n_bad = int(obs.get["n_rows"]), int(obs.get["n_rejected"])
    result = GateResult(entity, n_total, n_bad, n_bad / max(n_total, 1), limit)
    try:
        _publish(spark, f"{staged}/{INVALID}=true", rejects_root, ds, df)
        check_gate(result)
        _publish(spark, f"{staged}/{INVALID}=false", valid_root, ds, df)
    finally:
        L.delete(spark, staged)
    return result


def _publish(spark, side: str, root: str, ds: str, df: DataFrame) -> None:
    if L.exists(spark, side):
        L.move_into(spark, side, L.partition_dir(root, ds))
    else:
        L.write_day(spark.createDataFrame([], df.schema).coalesce(1), root, ds)
