"""Ordered fields as YAML, byte for byte as PyYAML writes them."""

from __future__ import annotations

import pandas as pd
import yaml
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..plans.shipping import ship


def typed(value: str, kind: str):
    """A field's value as YAML should see it."""
    number = lambda x: int(x) if x.isdigit() else x
    return {"num": number, "nums": lambda x: [number(p) for p in x.split("\n")], "list": lambda x: x.split("\n"), "raw": lambda x: yaml.safe_load(x)}.get(kind, lambda x: x)(value)


def yaml_text(fields: list) -> str:
    made = {f["k"]: typed(f["v"], f["kind"]) for f in fields}
    return yaml.safe_dump(made, sort_keys=False, allow_unicode=True, width=10_000) if made else ""


def yaml_series(fields: pd.Series) -> pd.Series:
    return fields.map(yaml_text)


def to_yaml(fields: Column) -> Column:
    ship()
    return F.pandas_udf(yaml_series, StringType())(fields)
