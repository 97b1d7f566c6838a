"""Column masks. Readers get the masked frame, never the table under it."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Mask = Callable[[str], Column]

# What a masked value looks like.
HIDDEN_DATE = date(1900, 1, 1)
HIDDEN_SSN = "***-**-****"
HIDDEN_TEXT = "REDACTED"


def date_mask(column: str) -> Column:
    return F.lit(HIDDEN_DATE)


def ssn_mask(column: str) -> Column:
    return F.lit(HIDDEN_SSN)


def redact(column: str) -> Column:
    """Text in place of any type: the masked column is a string."""
    return F.lit(HIDDEN_TEXT)


EMPLOYEE_POLICY: dict[str, Mask] = {"birth_date": date_mask, "ssn": ssn_mask, "salary": redact}


def apply_masks(df: DataFrame, policy: Mapping[str, Mask]) -> DataFrame:
    """Replace each governed column; the original is pruned from the scan."""
    return df.withColumns({column: mask(column) for column, mask in policy.items()})


#: Table property that holds the mask of a column, as an SQL expression.
PROPERTY = "mask."
#: The masks above as SQL.
EMPLOYEE_SQL = {"birth_date": f"DATE '{HIDDEN_DATE}'", "ssn": f"'{HIDDEN_SSN}'", "salary": f"'{HIDDEN_TEXT}'"}


def policy_of(spark: SparkSession, table: str) -> dict[str, str]:
    """Masks stored with a table, by column."""
    rows = spark.sql(f"SHOW TBLPROPERTIES {table}").collect()
    return {r["key"].removeprefix(PROPERTY): r["value"] for r in rows if r["key"].startswith(PROPERTY)}


def govern(spark: SparkSession, table: str, view: str) -> None:
    """(Re)build the view by which readers know the table: its columns in order, masked ones replaced."""
    policy = policy_of(spark, table)
    columns = [f"{policy[c]} AS `{c}`" if c in policy else f"`{c}`" for c in spark.table(table).columns]
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT {', '.join(columns)} FROM {table}")


def attach_mask(spark: SparkSession, table: str, view: str, column: str, expression: str) -> None:
    """M4. From now on every reader of the view sees the expression in place of the column."""
    if column not in spark.table(table).columns:
        raise ValueError(f"{table} has no column {column}")
    text = expression.replace("\\", "\\\\").replace('"', '\\"')
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{PROPERTY}{column}' = \"{text}\")")
    govern(spark, table, view)


def detach_mask(spark: SparkSession, table: str, view: str, column: str) -> None:
    """M4. Readers of the view see the column itself again."""
    spark.sql(f"ALTER TABLE {table} UNSET TBLPROPERTIES IF EXISTS ('{PROPERTY}{column}')")
    govern(spark, table, view)


def without_mask(policy: Mapping[str, Mask], *columns: str) -> dict[str, Mask]:
    """Policy with some columns detached."""
    return {column: mask for column, mask in policy.items() if column not in columns}
