"""The registry: tables of a data folder, query entries and their output types."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattlake.operators import report_measures
from wattlake.plans import combined, fact, staging
from wattlake.registry.sql import assemble
from wattlake.session import work_folder
from wattlake.sources import derived


class Tables:
    """The models over one data folder, each a lazy plan that is made when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    def read(self, table: str) -> DataFrame:
        return derived.read(self.spark, self.sf_dir, table)

    @cached_property
    def raw_eia(self) -> DataFrame:
        return derived.raw_eia(self.spark, self.sf_dir)

    @cached_property
    def raw_enrichment(self) -> DataFrame:
        return derived.raw_enrichment(self.spark, self.sf_dir)

    @cached_property
    def generation(self) -> DataFrame:
        return staging.stage_generation(self.raw_eia)

    @cached_property
    def consumption(self) -> DataFrame:
        return staging.stage_consumption(self.raw_eia)

    @cached_property
    def enrichment(self) -> DataFrame:
        return staging.stage_enrichment(self.raw_enrichment)

    @cached_property
    def dims(self) -> fact.Dimensions:
        return fact.Dimensions.seeds(self.spark)

    @cached_property
    def combined(self) -> DataFrame:
        return combined.combine(self.raw_eia, self.raw_enrichment)

    @cached_property
    def fact(self) -> DataFrame:
        return fact.build(self.raw_eia, self.raw_enrichment, self.dims)

    @cached_property
    def stored_rows(self) -> DataFrame:
        """Report rows of a written mart, for reports that scan it more than once."""
        return report_measures.with_report_columns(self.stored_fact)

    @cached_property
    def stored_fact(self) -> DataFrame:
        path = work_folder(self.spark, "mart") + "/fct_energy_metrics"
        self.fact.write.parquet(path)
        return self.spark.read.parquet(path)

    @cached_property
    def stored_combined(self) -> DataFrame:
        path = work_folder(self.spark, "combined") + "/int_energy_combined"
        self.combined.write.parquet(path)
        return self.spark.read.parquet(path)

    @cached_property
    def report_rows(self) -> DataFrame:
        return report_measures.with_report_columns(self.fact)


@dataclass(frozen=True)
class Entry:
    name: str
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return portable(self.build(Tables(spark, sf_dir)))


ENTRIES: dict[str, Entry] = {}


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` is its final SELECT over the shared common tables."""

    def register(build: Callable[[Tables], DataFrame]):
        if name in ENTRIES:
            raise ValueError(f"{name} is registered twice")
        ENTRIES[name] = Entry(name, build, assemble(sql) if sql else None)
        return build

    return register


def portable(table: DataFrame) -> DataFrame:
    """Output types that every client reads alike: long, double, text and boolean."""

    def output(field: T.StructField):
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DecimalType, T.FloatType)):
            column = column.cast("double")
        elif isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            column = column.cast("string")
        elif isinstance(field.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            column = column.cast("long")
        return column.alias(field.name)

    return table.select(*(output(f) for f in table.schema.fields))
