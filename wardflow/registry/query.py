"""A registered query: a Spark frame, and the same result as SQL where SQL can say it.

``columns`` lists ``name:kind`` pairs and shapes both sides alike. Kinds: i (64-bit
integer), d (double, 9 significant digits, 0 below 1e-12), s (string), t (timestamp, as text).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.registry.tables import TABLES

Frame = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    columns: str
    frame: Frame
    sql: str | None = None
    tables: tuple[str, ...] = ()

    def kinds(self) -> list[tuple[str, str]]:
        return [tuple(part.strip().rsplit(":", 1)) for part in self.columns.split(",")]

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        df = self.frame(spark, folder)
        return df.select(*[_spark_column(n, k) for n, k in self.kinds()])

    def oracle(self) -> str:
        ctes = ",\n".join(f"{n} AS ({TABLES[n][1].strip()})" for n in _with_needs(self.tables))
        head = f"WITH {ctes}\n" if ctes else ""
        columns = ", ".join(_sql_column(n, k) for n, k in self.kinds())
        return f"{head}SELECT {columns} FROM ({self.sql.strip()}) AS result"


def _spark_column(name: str, kind: str) -> Column:
    column = F.col(f"`{name}`")
    shaped = {
        "i": lambda: column.cast("bigint"),
        "d": lambda: _digits(column.cast("double")),
        "s": lambda: column.cast("string"),
        "t": lambda: column.cast("string"),
    }[kind]()
    return shaped.alias(name)


def _digits(number: Column) -> Column:
    digits = F.format_string("%.8e", number).cast("double")
    return F.when(F.abs(number) < 1e-12, 0.0).when(number.isNotNull(), digits)


def _sql_column(name: str, kind: str) -> str:
    column = f'"{name}"'
    shaped = {
        "i": f"CAST({column} AS BIGINT)",
        "d": f"CASE WHEN abs(CAST({column} AS DOUBLE)) < 1e-12 THEN 0.0"
        f" ELSE CAST(printf('%.8e', CAST({column} AS DOUBLE)) AS DOUBLE) END",
        "s": f"CAST({column} AS VARCHAR)",
        "t": f"CAST({column} AS VARCHAR)",
    }[kind]
    return f"{shaped} AS {column}"


def _with_needs(names: tuple[str, ...]) -> list[str]:
    found: list[str] = []
    for name in names:
        for part in (*_with_needs(TABLES[name][0]), name):
            if part not in found:
                found.append(part)
    return found
