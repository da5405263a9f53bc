"""Named views built from SQL text, each after the views it reads."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


class Views:
    """A catalogue of views by name. ``build`` creates them in the order of their references.

    A query names other views in braces, or plainly where there is no prefix; a plain
    name is known when Spark does not find it, and its view is made then. Nothing is
    read or run.
    """

    def __init__(self, spark: SparkSession, views: dict[str, str] | None = None, prefix: str = ""):
        self.spark, self.prefix, self.queries, self.tables = spark, prefix, {}, set()
        for name, text in (views or {}).items():
            self.add(name, text)

    def add(self, name: str, text: str) -> Views:
        """Set a view's query; ``{name}`` stands for a view or table of this catalogue, with its prefix."""
        if not name.isidentifier():
            raise ValueError(f"{name!r} is no name for a view")
        self.queries[name.lower()] = text
        return self

    def full_name(self, name: str) -> str:
        return f"{self.prefix}{name.lower()}"

    def add_table(self, name: str, df: DataFrame) -> Views:
        """A table that views can read."""
        df.createOrReplaceTempView(self.full_name(name))
        self.tables.add(name.lower())
        return self

    def build(self) -> list[str]:
        """Create or replace all views; the order in which they were made."""
        for name in self.queries:
            self.spark.catalog.dropTempView(self.full_name(name))
        made: list[str] = []
        for name in self.queries:
            self._make(name, [], made)
        return made

    def _make(self, name: str, above: list[str], made: list[str]) -> None:
        if name in made:
            return
        if name in above:
            raise ValueError("views read each other: " + " -> ".join([*above[above.index(name):], name]))
        text = self.queries[name]
        for other in re.findall(r"\{(\w+)\}", text):
            if other.lower() not in self.queries and other.lower() not in self.tables:
                raise ValueError(f"view {name} reads {other}, which is not there")
            if other.lower() in self.queries:
                self._make(other.lower(), [*above, name], made)
            text = text.replace("{" + other + "}", self.full_name(other))
        while True:
            try:
                self.spark.sql(text).createOrReplaceTempView(self.full_name(name))
            except AnalysisException as e:
                missing = self._missing(e)
                if missing is None:
                    raise
                self._make(missing, [*above, name], made)
            else:
                made.append(name)
                return

    def _missing(self, e: AnalysisException) -> str | None:
        """The view of this catalogue that a query did not find."""
        if e.getCondition() != "TABLE_OR_VIEW_NOT_FOUND":
            return None
        wanted = e.getMessageParameters()["relationName"].replace("`", "").lower()
        names = {self.full_name(name): name for name in self.queries}
        return names.get(wanted)

    def read(self, name: str) -> DataFrame:
        return self.spark.table(self.full_name(name))

    def drop(self) -> None:
        for name in self.queries:
            self.spark.catalog.dropTempView(self.full_name(name))
