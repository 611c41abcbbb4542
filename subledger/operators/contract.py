"""Column contracts: names and type families checked against ``df.schema``.

The check is on the schema only (no data pass).  Column order is not enforced:
the result is selected in contract order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Contract type names -> accepted Spark types.
FAMILIES = {
    "integer": (T.LongType, T.IntegerType, T.ShortType, T.ByteType),
    "float64": (T.DoubleType, T.FloatType),
    "float": (T.DoubleType, T.FloatType),
    "string": (T.StringType,),
    "boolean": (T.BooleanType,),
    "date": (T.DateType,),
    "timestamp": (T.TimestampType, T.TimestampNTZType),
}


class ContractError(ValueError):
    pass


def contract_violations(df: DataFrame, contract: Sequence[tuple[str, str]]) -> list[str]:
    fields = {f.name: f.dataType for f in df.schema.fields}
    problems = []
    for name, family in contract:
        if name not in fields:
            problems.append(f"missing column {name}")
        elif not isinstance(fields[name], FAMILIES[family]):
            problems.append(f"{name}: expected {family}, got {fields[name].simpleString()}")
    extra = set(fields) - {n for n, _ in contract}
    problems += [f"column {n} not in contract" for n in sorted(extra)]
    return problems


def enforce_contract(df: DataFrame, contract: Sequence[tuple[str, str]]) -> DataFrame:
    """Raise :class:`ContractError` on a mismatch, else select in contract order."""
    problems = contract_violations(df, contract)
    if problems:
        raise ContractError("; ".join(problems))
    return df.select(*[n for n, _ in contract])
