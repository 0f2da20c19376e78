"""The engine: one source as a database of tables."""

from __future__ import annotations

import json
import logging
import re
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import replace
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import EngineError
from ..operators.explode import quoted, view_sql
from ..session import prepare
from ..sources import metrics
from ..sources import config as configs
from ..sources import spec as specs
from ..sources.config import Source
from ..sources.datasource import Pushed, RestSource, check_streams
from ..sources.tables import Catalog, TableSpec
from ..streaming.checkpoints import Store
from . import rewrites

log = logging.getLogger("tidewire")

#: A limit up to this is worth a broadcast hint: such a table's size is known.
BROADCAST_ROWS = 10_000


class Engine:
    """A source's tables as ``<name>.<table>``, for SQL, DataFrames, incremental and streaming reads."""

    def __init__(self, spark: SparkSession, name: str, config: str | Source, description: Any = None):
        """config: a file's path, or a checked configuration; description: a parsed API description instead of its own."""
        if not re.fullmatch(r"\w+", name):
            raise EngineError(f"{name!r} can't be a database's name")
        prepare(spark)
        self.spark, self.name = spark, name
        source = configs.load(config) if isinstance(config, str) else config
        spec = specs.parse(description) if description is not None else specs.read(source.openapi, source.cache, source.http.timeout)
        self.catalog = Catalog(source, spec)
        self._registered: set[str] = set()

    @property
    def source(self) -> Source:
        return self.catalog.source

    def tables(self) -> list[str]:
        return self.catalog.names()

    def exists(self, table: str) -> bool:
        try:
            self.catalog.table(table)
            return True
        except EngineError:
            return False

    def describe(self, table: str) -> list[tuple[str, str]]:
        spec = self.catalog.table(table)
        return [("value", "variant")] if spec.variant else [(c.name, c.type) for c in spec.columns]

    def _format(self, spec: TableSpec, strict: bool = False) -> str:
        """The name of the data source bound to a table. strict: with typed columns, whatever the mode is."""
        name = f"{self.name}__{'strict__' if strict else ''}{spec.name}".lower()
        if name not in self._registered:
            catalog, table = self.catalog, spec.name
            if strict:
                catalog = Catalog(replace(self.source, schema=replace(self.source.schema, mode="strict")), self.catalog.spec)

            class Bound(RestSource):
                CATALOG = catalog
                TABLE = table

                @classmethod
                def name(cls) -> str:
                    return name

            self.spark.dataSource.register(Bound)
            self._registered.add(name)
        return name

    def register(self) -> "Engine":
        """Creates the database and its tables and views, so that plain Spark SQL reads them."""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(self.name)}")
        for name in [*self.catalog.base_names(), *(n for n in self.tables())]:
            try:
                self._create(self.catalog.table(name))
            except EngineError as error:
                log.warning("table %s isn't registered: %s", name, error)
        return self

    def _create(self, spec: TableSpec) -> None:
        target = f"{quoted(self.name)}.{quoted(spec.name)}"
        if spec.kind == "exploded":
            base = f"{quoted(self.name)}.{quoted(spec.parent.name)}"
            if self.source.schema.mode == "variant":  # arrays need typed parents
                base = f"{quoted(self.name)}.{quoted(f'_strict_{spec.parent.name}')}"
                self.spark.sql(f"DROP TABLE IF EXISTS {base}")
                self.spark.sql(f"CREATE TABLE {base} USING {self._format(spec.parent, strict=True)}")
            self.spark.sql(f"CREATE OR REPLACE VIEW {target} AS {view_sql(spec, base, self.source.schema.explode_outer)}")
            return
        kind = self._format(spec)
        self.spark.sql(f"DROP TABLE IF EXISTS {target}")
        self.spark.sql(f"CREATE TABLE {target} USING {kind}")

    def unregister(self) -> None:
        self.spark.sql(f"DROP DATABASE IF EXISTS {quoted(self.name)} CASCADE")

    def table(self, name: str, columns: list[str] | None = None, limit: int | None = None, where: dict[str, Any] | None = None, parallelism: int = 1, verify: bool = False, options: dict[str, str] | None = None) -> DataFrame:
        """A table as a DataFrame.

        columns: only these are converted and returned. limit: at most so many rows, which the API is told. where:
        columns and the values that they must equal. parallelism: a child table's parent keys are read first and
        divided among so many tasks. verify: filters aren't pushed.
        """
        spec = self.catalog.table(name)
        if spec.kind == "exploded":
            base = self._strict_base(spec.parent, options) if self.source.schema.mode == "variant" else self.table(spec.parent.name, where={k: v for k, v in (where or {}).items() if k in {c.name for c in spec.parent.columns}}, verify=verify, options=options)
            view = f"_{self.name}_{spec.name}_base"
            base.createOrReplaceTempView(view)
            out = self.spark.sql(view_sql(spec, quoted(view), self.source.schema.explode_outer))
        else:
            reader = self.spark.read.format(self._format(spec))
            for k, v in (options or {}).items():
                reader = reader.option(k, v)
            if columns is not None and not spec.variant:
                needed = set(columns) | set(where or {})
                reader = reader.option("_columns", json.dumps([c.name for c in spec.columns if c.name in needed]))
            if limit is not None and not where:
                reader = reader.option("_limit", limit)
            if parallelism > 1:
                reader = reader.option("_parallelism", parallelism)
            if verify:
                reader = reader.option("_verify", "true")
            out = reader.load()
        for k, v in (where or {}).items():
            out = out.filter(F.col(quoted(k)) == v)
        if columns is not None:
            out = out.select(*[F.col(quoted(c)) for c in columns])
        if limit is not None:
            out = out.limit(limit)
            if limit <= BROADCAST_ROWS:
                out = F.broadcast(out)
        return out

    def _strict_base(self, spec: TableSpec, options: dict[str, str] | None) -> DataFrame:
        return self.spark.read.format(self._format(spec, strict=True)).options(**(options or {})).load()

    def sql(self, text: str) -> DataFrame:
        """A query; ``<name>.default.<table>`` is understood, and columns, limits and aggregates reach the API."""
        text = rewrites.three_parts(text, self.name)
        df = self.spark.sql(text)
        try:
            return self._rewritten(text, df)
        except Exception as error:  # plans are Spark internals: without a rewrite the query is only slower
            log.info("not rewritten: %s", error)
            return df

    def _rewritten(self, text: str, df: DataFrame) -> DataFrame:
        execution = df._jdf.queryExecution()
        query = rewrites.aggregate_query(execution.analyzed(), self.name)
        if query is not None:
            out = self._pushed_aggregate(query, df)
            if out is not None:
                return out
        for table, options in rewrites.read_options(execution.optimizedPlan(), self.name).items():
            changed = rewrites.with_options(text, self.name, table, options)
            if changed is not None:
                text = changed
                df = self.spark.sql(text)
        return df

    def _pushed_aggregate(self, query: rewrites.AggregateQuery, df: DataFrame) -> DataFrame | None:
        spec = self.catalog.table(query.table)
        if spec.kind != "base" or spec.variant:
            return None
        planned = self.plan_aggregates(spec, query.functions)
        if planned is None:
            return None
        pushed = Pushed(self.source, spec)
        if not all(pushed.push(*c) for c in query.comparisons):
            return None
        out = self._read_aggregates(spec, planned, pushed.params)
        return out.select(*[F.col(f"a{i}").cast(f.dataType).alias(f.name) for i, f in enumerate(df.schema)])

    def plan_aggregates(self, spec: TableSpec, functions: list[tuple[str, str | None]]) -> list[tuple[str, str]] | None:
        """The configured aggregation and the type of each function; None unless all of them have one."""
        types = {c.name: c.type for c in spec.columns}
        out = []
        for function, column in functions:
            a = next((a for a in spec.table.aggregations if a.function == function and a.column == column), None)
            if a is None or function not in ("count", "sum", "avg"):
                return None
            out.append((a.name, "bigint" if function == "count" or function == "sum" and types.get(column) in ("int", "bigint") else "double"))
        return out

    def _read_aggregates(self, spec: TableSpec, planned: list[tuple[str, str]], params: dict[str, str]) -> DataFrame:
        schema = ", ".join(f"a{i} {t}" for i, (_, t) in enumerate(planned))
        reader = self.spark.read.format(self._format(spec)).option("_aggregates", json.dumps(planned)).option("_schema", schema)
        return reader.option("_params", json.dumps(params)).load()

    def aggregate(self, table: str, **columns: tuple[str, str | None]) -> DataFrame:
        """One row of pushed aggregates, such as aggregate("t", n=("count", None), total=("sum", "x"))."""
        spec = self.catalog.table(table)
        planned = self.plan_aggregates(spec, list(columns.values()))
        if planned is None:
            known = ", ".join(f"{a.function}({a.column or '*'})" for a in spec.table.aggregations) or "none"
            raise EngineError(f"table {table}: not all of these aggregates have a configuration; there are: {known}")
        out = self._read_aggregates(spec, planned, {})
        return out.select(*[F.col(f"a{i}").alias(n) for i, n in enumerate(columns)])

    @contextmanager
    def incremental(self, table: str, **kwargs: Any) -> Iterator[DataFrame]:
        """The rows since the saved position; it moves when the block ends without an error, and only then."""
        spec = self.catalog.table(table)
        c = spec.table.checkpoint
        if c is None or not c.enabled:
            raise EngineError(f"table {table} has no checkpoint")
        store = Store(c.path, spec.table.name)
        store.discard()
        try:
            yield self.table(table, options={"_incremental": "true"}, **kwargs)
        except BaseException:
            store.discard()
            raise
        store.promote()

    def read_stream(self, table: str, options: dict[str, str] | None = None) -> DataFrame:
        """A streaming DataFrame of what changes from now on."""
        spec = self.catalog.table(table)
        check_streams(spec)
        reader = self.spark.readStream.format(self._format(spec))
        for k, v in (options or {}).items():
            reader = reader.option(k, v)
        return reader.load()

    @contextmanager
    def conversions(self, table: str) -> Iterator[tuple[DataFrame, dict[str, int]]]:
        """A table, and counts of converted values and of those made NULL, filled in when the block ends."""
        folder = metrics.new_folder(self.spark.conf.get("spark.checkpoint.dir", None))
        counts = {"converted": 0, "nulled": 0}
        try:
            yield self.table(table, options={"_metrics": folder}), counts
            for found in metrics.read(folder):
                for k in counts:
                    counts[k] += sum(found[k].values())
        finally:
            metrics.drop(folder)


