"""A context gives the entity sets of a model over a folder of Parquet tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from queryset.operators.query import Query, root
from queryset.sources.model import Model


class Context:
    """``ctx.orders`` or ``ctx.set("orders")`` is a query over all rows of an entity set.

    ``tables`` maps a table's name to a DataFrame and goes before the folder; versions
    and transactions use it. ``interceptors`` may replace a root query.
    """

    def __init__(self, spark: SparkSession, folder: str, model: Model, tables: Callable[[str], DataFrame | None] | None = None):
        self.spark, self.folder, self.model, self.tables = spark, folder, model, tables
        self.interceptors: list[Callable[[Query], Query]] = []

    def table(self, name: str) -> DataFrame:
        found = self.tables(name) if self.tables else None
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet") if found is None else found

    def set(self, name: str, ignore_filters: bool | list[str] = False) -> Query:
        """``ignore_filters``: True leaves out all of the type's filters, a list those named."""
        query = root(self, self.model[name], ignore_filters)
        for intercept in self.interceptors:
            query = intercept(query)
        return query

    def inline(self, values: list, kind: str) -> Query:
        """A local list as a source of scalars; an empty list has its type too."""
        return Query.of_scalar(self, self.spark.createDataFrame([(v,) for v in values], f"value {kind}"))

    def __getattr__(self, name: str) -> Query:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.set(name)
