"""User functions: one registration surface for scalar, grouped, table and batch functions, and declared operator contracts."""

from __future__ import annotations

import importlib
from collections.abc import Callable
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType


def scalar(spark: SparkSession, name: str, result: str, f: Callable[..., pd.Series]) -> None:
    """Registers a vectorised scalar function for SQL."""
    spark.udf.register(name, F.pandas_udf(f, result))


def aggregate(spark: SparkSession, name: str, result: str, f: Callable[[pd.Series], float]) -> None:
    """Registers a grouped reduction for SQL; ``f`` is annotated Series -> scalar."""

    def reduce(values: pd.Series) -> float:
        return f(values)

    spark.udf.register(name, F.pandas_udf(reduce, result))


def table(spark: SparkSession, name: str, result: str, handler: type) -> None:
    """Registers a table function: ``handler`` has ``eval`` that yields rows."""
    spark.udtf.register(name, F.udtf(handler, returnType=result))


def dotted(f: Callable) -> str:
    return f"{f.__module__}.{f.__qualname__}"


def from_dotted(path: str) -> Callable:
    module, _, name = path.rpartition(".")
    out = importlib.import_module(module)
    for part in name.split("."):
        out = getattr(out, part)
    return out


def type_to_json(kind: DataType) -> str:
    return kind.json()


def schema_from_json(text: str) -> StructType:
    import json

    return StructType.fromJson(json.loads(text))


@dataclass
class Operator:
    """A DataFrame function with the columns that it needs and makes."""

    run: Callable[..., DataFrame]
    needs: dict[str, str] = field(default_factory=dict)
    makes: dict[str, str] = field(default_factory=dict)

    def __call__(self, df: DataFrame, **options) -> DataFrame:
        have = dict(df.dtypes)
        for name, kind in self.needs.items():
            if have.get(name) != kind:
                raise TypeError(f"column {name} must be {kind}, not {have.get(name)}")
        out = self.run(df, **options)
        got = dict(out.dtypes)
        for name, kind in self.makes.items():
            if got.get(name) != kind:
                raise TypeError(f"result column {name} is {got.get(name)}, not {kind}")
        return out


@dataclass
class Pipeline:
    """Operators in order, by dotted path, so that a plan can be written down and read back."""

    steps: list[tuple[str, dict]]

    def __call__(self, df: DataFrame) -> DataFrame:
        for path, options in self.steps:
            df = from_dotted(path)(df, **options)
        return df

    def dumps(self) -> str:
        import json

        return json.dumps({"steps": [{"run": p, "options": o} for p, o in self.steps]})

    @classmethod
    def loads(cls, text: str) -> Pipeline:
        import json

        return cls([(s["run"], s["options"]) for s in json.loads(text)["steps"]])


def bounded_loop(df: DataFrame, step: Callable[[DataFrame], DataFrame], done: Callable[[DataFrame], bool], most: int) -> DataFrame:
    """Repeats ``step`` until ``done``; each round is a checkpoint; more than ``most`` rounds raise."""
    for _ in range(most):
        if done(df):
            return df
        df = step(df).checkpoint()
    if done(df):
        return df
    raise RuntimeError(f"the loop ran {most} times without an end")
