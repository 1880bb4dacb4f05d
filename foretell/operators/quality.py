"""Contract and constraint checks as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foretell import constants as C
from foretell.schemas import CONTRACTS


def _present(df: DataFrame) -> dict[str, str]:
    return {c.upper(): c for c in df.columns}


def missing_fields(df: DataFrame, contract: str) -> Column:
    """One message per required field that is absent or null; none for an unknown contract."""
    present = _present(df)
    messages = []
    for field, required in CONTRACTS.get(contract, ()):
        if not required:
            continue
        text = F.lit(f"Missing required field: {field}")
        messages.append(F.when(F.col(present[field]).isNull(), text) if field in present else text)
    if not messages:
        return F.array().cast("array<string>")
    return F.filter(F.array(*messages), lambda m: m.isNotNull())


def validate(df: DataFrame, contract: str) -> DataFrame:
    """Adds ``errors``; valid rows have none."""
    return df.withColumn("errors", missing_fields(df, contract))


def split_valid(df: DataFrame, contract: str) -> tuple[DataFrame, DataFrame]:
    checked = validate(df, contract)
    bad = F.size("errors") > 0
    return checked.where(~bad).drop("errors"), checked.where(bad)


def encode_contract(df: DataFrame, contract: str) -> DataFrame:
    """Keep the contract's fields and serialize; nulls are written out."""
    present = _present(df)
    fields = [
        F.col(present[field]).alias(field) for field, _ in CONTRACTS[contract] if field in present
    ]
    return df.select(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("value"))


def constraint_rules() -> dict[str, tuple[str, Column]]:
    """rule -> (column it needs, condition); a null condition passes, as in SQL CHECK."""
    return {
        "valid_outcome": ("actual_outcome", F.col("actual_outcome").isin(0, 1)),
        "valid_error": ("prediction_error", F.col("prediction_error").between(0, 1)),
        "valid_severity": ("severity", F.col("severity").isin(*C.SEVERITIES)),
        "valid_alert_type": ("alert_type", F.col("alert_type").isin(*C.ALERT_TYPES)),
        "valid_status": ("status", F.col("status").isin(*C.HEALTH_STATUSES)),
    }


def check_constraints(df: DataFrame) -> DataFrame:
    """Adds ``violations``: names of the rules a row breaks."""
    broken = [
        F.when(~rule, F.lit(name))
        for name, (column, rule) in constraint_rules().items()
        if column in df.columns
    ]
    return df.withColumn("violations", F.filter(F.array(*broken), lambda v: v.isNotNull()))


def with_details(health: DataFrame, **fields: str) -> DataFrame:
    """Adds ``details``: the named columns as one JSON object."""
    return health.withColumn("details", F.to_json(F.struct(*[F.col(c).alias(name) for name, c in fields.items()])))


def detail(name: str, kind: str = "string", column: str = "details") -> Column:
    """A field of the JSON object, null where it is missing or not of that kind."""
    return F.get_json_object(F.col(column), f"$.{name}").try_cast(kind)
