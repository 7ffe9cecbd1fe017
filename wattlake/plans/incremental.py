"""The mart by mergeable state: late rows are added, raw rows are never read again.

Beside the mart lie two tables by month: the energy cube, whose sums and maxima merge by addition
and comparison, and the staged enrichment, whose rows are facts of their own and are only added to. A batch of new raw
rows is summed into a cube of its own, merged with the stored cube of the months it touches, and
the fact rows of the keys that it touches are made anew from the state: the mart's rows of these
metric keys are deleted, the new ones inserted, all others of the month are carried over. Cube,
enrichment and mart are one commit.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattlake import schemas
from wattlake.operators import aggregates
from wattlake.plans import fact as fact_model
from wattlake.plans import refresh, staging
from wattlake.session import work_folder
from wattlake.sources.versions import Snapshot, VersionedStore, Write

MONTH = ("year", "month")
CUBE, ENRICHMENT, MART = "energy_cube", "enrichment", "fct_energy_metrics"
_CUBE_KEYS = [*aggregates.PERIOD_LOCATION, "energy_source", "sector", "is_generation", "is_consumption"]
_CONTEXT = ["temperature_fahrenheit", "population", "gdp_per_capita", "industrial_activity_index"]


def _month_of_date(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"year": F.year("period_date"), "month": F.month("period_date")})


def _partition(year: Column, month: Column) -> Column:
    return F.concat(F.lit("year="), year, F.lit("/month="), month)


def cube_of(raw_eia: DataFrame) -> DataFrame:
    """Partial sums of raw rows; those of several batches merge to those of all rows."""
    return aggregates.energy_cube(staging.tag_energy(raw_eia)).select(
        *_CUBE_KEYS, F.col("mwh").cast(T.DecimalType(38, 7)).alias("mwh"), "ingestion_timestamp"
    )


def merge_cubes(*cubes: DataFrame) -> DataFrame:
    return (
        reduce(DataFrame.unionByName, cubes)
        .groupBy(*_CUBE_KEYS)
        .agg(
            F.sum("mwh").cast(T.DecimalType(38, 7)).alias("mwh"),
            F.max("ingestion_timestamp").alias("ingestion_timestamp"),
        )
    )


def context_of(raw_enrichment: DataFrame) -> DataFrame:
    return staging.stage_enrichment(raw_enrichment).select(
        *aggregates.PERIOD_LOCATION, "source_id", *_CONTEXT
    )


def facts_of(cube: DataFrame, context: DataFrame, dims: fact_model.Dimensions) -> DataFrame:
    base = fact_model.with_measures(fact_model.look_up_keys(aggregates.pivot_cube(cube), dims))
    return fact_model.add_enrichment(base, context, dims).select(*fact_model.OUTPUT_COLUMNS)


class IncrementalMart:
    """A mart and its state under one root. All batches have to come through apply().

    Rows outside of the calendar never reach the mart and are not kept in the state; after the
    calendar has grown, build the mart anew from the raw layer.
    """

    def __init__(self, spark: SparkSession, root: str, dims: fact_model.Dimensions | None = None) -> None:
        self.spark, self.store = spark, VersionedStore(spark, root)
        self.dims = dims or fact_model.Dimensions.seeds(spark)
        empty_eia = spark.createDataFrame([], schemas.RAW_EIA)
        empty_enrichment = spark.createDataFrame([], schemas.RAW_ENRICHMENT)
        cube, context = cube_of(empty_eia), context_of(empty_enrichment)
        mart = facts_of(cube, context, self.dims)
        self._schemas = {
            CUBE: _month_of_date(cube).schema, ENRICHMENT: _month_of_date(context).schema,
            MART: refresh.with_partitions(mart).schema,
        }

    def read(self, table: str = MART, snapshot: Snapshot | None = None, partitions=None) -> DataFrame:
        return self.store.read(table, self._schemas[table], snapshot, partitions)

    def _touched(self, *new: DataFrame) -> frozenset[str]:
        """Months of new rows within the calendar, as partitions. No more than the calendar has."""
        calendar = self.dims.time.select(
            _partition(F.year("date"), F.month("date")).alias("part")
        ).distinct()
        months = reduce(DataFrame.unionByName, [n.select("period_date") for n in new]).select(
            _partition(F.year("period_date"), F.month("period_date")).alias("part")
        ).distinct()
        return frozenset(r.part for r in months.join(calendar, "part", "left_semi").collect())

    def apply(self, raw_eia: DataFrame, raw_enrichment: DataFrame, batch: str | None = None) -> Snapshot:
        """Merge a batch of new raw rows. A batch id that was applied before changes nothing, so a
        batch may be sent again after a failure. Rows of the batch count once each."""
        base = self.store.snapshot()
        if batch is not None and batch in base.tags:
            return base
        return self.store.commit(self.plan(raw_eia, raw_enrichment, base), base, batch)

    def plan(self, raw_eia: DataFrame, raw_enrichment: DataFrame, base: Snapshot) -> dict[str, Write]:
        """The rows to write for a batch. The batch's sums and its enrichment are written first, as
        a work table that all that follows reads in place of the raw rows."""
        folder = work_folder(self.spark, "batch")
        _month_of_date(cube_of(raw_eia)).write.parquet(f"{folder}/{CUBE}")
        _month_of_date(context_of(raw_enrichment)).write.parquet(f"{folder}/{ENRICHMENT}")
        new = {t: self.spark.read.schema(self._schemas[t]).parquet(f"{folder}/{t}") for t in (CUBE, ENRICHMENT)}
        parts = self._touched(*new.values())
        part = _partition(F.col("year"), F.col("month"))
        inside = {t: rows.where(part.isin(*parts)) if parts else rows.limit(0) for t, rows in new.items()}
        cube = merge_cubes(
            self.read(CUBE, base, parts).select(*_CUBE_KEYS, "mwh", "ingestion_timestamp"),
            inside[CUBE].select(*_CUBE_KEYS, "mwh", "ingestion_timestamp"),
        )
        context = self.read(ENRICHMENT, base, parts).unionByName(inside[ENRICHMENT])
        # As many keys at most as the calendar and the locations allow, plus unknown locations.
        keys = reduce(
            DataFrame.unionByName, [rows.select(*aggregates.PERIOD_LOCATION) for rows in inside.values()]
        ).distinct()
        rows = facts_of(
            cube.join(keys, aggregates.PERIOD_LOCATION, "left_semi"),
            context.drop(*MONTH).join(keys, aggregates.PERIOD_LOCATION, "left_semi"),
            self.dims,
        )
        renamed = fact_model.look_up_keys(keys, self.dims).select("metric_key")
        stays = self.read(MART, base, parts).join(renamed, "metric_key", "left_anti")
        mart = refresh.with_partitions(rows).unionByName(stays.select(*self._schemas[MART].names))
        return {
            CUBE: Write(_month_of_date(cube), MONTH, parts),
            ENRICHMENT: Write(inside[ENRICHMENT], MONTH, appends=True),
            MART: Write(mart, MONTH, parts),
        }
