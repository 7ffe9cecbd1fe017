"""Raw-layer tables derived from the TPC-H-like test tables by fixed rules.

They carry every quirk that the staging rules must handle: odd units, padded codes,
divisions, missing types, sources and values, and periods of four shapes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the derivation rules, each list by remainder.
UNITS = ["MWh", "megawatthours", "thousand MWh", "GWh", "kWh", " gwh ", None]
LOCATIONS = ["US", "ne", "MW", "US-S", " us-w ", "CA", "tx", "NY ", "US-FL", "il"]
SOURCES = [
    "coal", "natural_gas", "Nuclear", " solar", "WIND", "hydro", "petroleum", "Natural Gas", None,
]
SECTORS = ["residential", "Commercial", "industrial", "transportation", " electric power "]
DIM_CODES = [
    "US", "US-NE", "US-MW", "US-S", "US-W", "US-CA", "US-TX", "US-NY", "US-FL", "US-IL",
]
YEARS_FORWARD = 25


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _pick(values: list[str | None], remainder: str) -> str:
    texts = ", ".join("NULL" if v is None else f"'{v}'" for v in values)
    return f"element_at(array({texts}), CAST({remainder} + 1 AS INT))"


def _forward(column: str) -> str:
    return f"add_months(CAST({column} AS DATE), {12 * YEARS_FORWARD})"


def raw_eia(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "lineitem")
    shipped = rows.selectExpr(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag",
        "CAST(l_quantity AS DECIMAL(18,4)) AS quantity",
        f"{_forward('l_shipdate')} AS shipped",
    )
    return shipped.selectExpr(
        "((l_orderkey * 10 + l_linenumber) * 100000 + l_partkey) * 10000 + l_suppkey AS id",
        "'EIA' AS source",
        "CAST(shipped AS TIMESTAMP_NTZ) AS ingestion_timestamp",
        """CASE WHEN l_partkey % 11 = 0 THEN 'elec.revenue.x'
             WHEN l_returnflag = 'R' THEN 'ELEC.SALES.RES'
             WHEN l_returnflag = 'A' THEN 'ELEC.GEN.ALL'
             WHEN l_partkey % 3 = 1 THEN 'ELEC.GENERATION.ALL'
             WHEN l_partkey % 3 = 2 THEN 'ELEC.CONSUMPTION.TOT' END AS series_id""",
        """CASE l_orderkey % 50 WHEN 0 THEN substring(CAST(shipped AS STRING), 1, 4)
             WHEN 1 THEN 'n/a' WHEN 2 THEN CAST(shipped AS STRING)
             ELSE substring(CAST(shipped AS STRING), 1, 7) END AS period""",
        """CASE l_partkey % 97 WHEN 0 THEN NULL WHEN 1 THEN -quantity
             WHEN 2 THEN CAST(0 AS DECIMAL(18,4)) ELSE quantity END AS value""",
        f"{_pick(UNITS, 'l_partkey % 7')} AS units",
        f"{_pick(LOCATIONS, 'l_suppkey % 10')} AS location",
        """CASE WHEN l_orderkey % 40 = 0 THEN 'mountain' WHEN l_orderkey % 40 = 1 THEN NULL
             WHEN l_orderkey % 40 = 2 THEN 'Mountain' WHEN l_suppkey % 10 = 0 THEN 'national'
             WHEN l_suppkey % 10 <= 4 THEN 'Region' ELSE 'state' END AS location_type""",
        f"{_pick(SOURCES, 'l_orderkey % 9')} AS energy_source",
        f"CASE WHEN l_linenumber <= 5 THEN {_pick(SECTORS, 'l_linenumber - 1')} END AS sector",
        "CAST(NULL AS STRING) AS raw_json",
    )


def raw_enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many rows for the same period and location, as hourly appends leave them."""
    rows = read(spark, sf_dir, "orders")
    ordered = rows.selectExpr(
        "o_orderkey", "o_custkey", f"{_forward('o_orderdate')} AS ordered",
        """CASE WHEN o_orderkey % 53 <> 0
             THEN CAST((o_orderkey % 2200) / 10 - 60 AS DECIMAL(18,4)) END AS temperature_avg""",
    )
    return ordered.selectExpr(
        "o_orderkey AS id",
        "'FastAPI' AS source",
        "CAST(ordered AS TIMESTAMP_NTZ) AS ingestion_timestamp",
        "CAST(trunc(ordered, 'MM') AS STRING) AS period",
        f"{_pick(DIM_CODES, 'o_custkey % 10')} AS location",
        "temperature_avg",
        "CASE WHEN temperature_avg IS NOT NULL THEN 'fahrenheit' END AS temperature_unit",
        "CASE WHEN o_orderkey % 59 <> 0 THEN o_custkey * 12345 % 20000000 END AS population",
        """CAST(CASE WHEN o_orderkey % 7 <> 0 THEN 40000 + o_custkey % 60000 END
             AS DECIMAL(18,4)) AS gdp_per_capita""",
        """CAST(CASE WHEN o_orderkey % 13 <> 0 THEN 70 + o_orderkey % 61 END
             AS DECIMAL(18,4)) AS industrial_activity_index""",
        "CAST(NULL AS STRING) AS raw_json",
    )


def eia_record_texts(raw: DataFrame) -> DataFrame:
    """JSON record texts of raw rows: residential and commercial rows in the first naming
    family, all others in the second, which has no series id. Rows without a location type
    lack the location key; divisions have an explicit null there."""
    value = F.col("value").cast("double")
    no_key = F.col("location_type").isNull()
    null_location = F.coalesce(F.col("location_type") == "mountain", F.lit(False))
    location = F.when(~no_key & ~null_location, F.col("location"))
    first = F.to_json(
        F.struct(
            "period",
            F.col("series_id").alias("seriesId"),
            value.alias("value"),
            "units",
            location.alias("location"),
            F.col("location_type").alias("locationType"),
            F.col("energy_source").alias("energySource"),
            "sector",
        )
    )
    second = F.to_json(
        F.struct(
            "period",
            value.alias("generation"),
            F.col("units").alias("generation-units"),
            location.alias("location"),
            F.col("location_type").alias("stateDescription"),
            F.col("energy_source").alias("fuelTypeDescription"),
            F.col("sector").alias("sectorDescription"),
        )
    )
    is_first = F.coalesce(F.col("sector").isin("residential", "Commercial"), F.lit(False))
    text = F.when(is_first, first).otherwise(second)
    with_null = F.concat(F.expr("substring(text, 1, length(text) - 1)"), F.lit(',"location":null}'))
    texts = raw.select("id", "value", text.alias("text"), null_location.alias("null_location"))
    sent = F.when(F.col("null_location"), with_null).otherwise(F.col("text"))
    return texts.select("id", "value", sent.alias("text"))


def eia_pages(raw: DataFrame) -> DataFrame:
    """API pages of one record; rows without a value come as a page without the envelope."""
    page = F.concat(
        F.lit('{"response":{"total":1,"data":['), F.col("text"), F.lit(']},"apiVersion":"2"}')
    )
    error = F.lit('{"error":"no data","apiVersion":"2"}')
    return eia_record_texts(raw).select(
        "id", F.when(F.col("value").isNotNull(), page).otherwise(error).alias("value")
    )


def enrichment_record_texts(raw: DataFrame) -> DataFrame:
    """JSON record texts of raw enrichment rows. Rows without an activity index give their
    GDP under the second name only; rows without a population have a 0 under the first."""
    gdp = F.col("gdp_per_capita").cast("double")
    second_only = F.col("industrial_activity_index").isNull()
    zero_first = F.col("population").isNull()
    usd = F.when(zero_first, F.lit(0.0)).when(~second_only, gdp)
    return raw.select(
        "id",
        F.to_json(
            F.struct(
                "location",
                "period",
                F.col("temperature_avg").cast("double").alias("temperature_fahrenheit"),
                "population",
                usd.alias("gdp_per_capita_usd"),
                F.when(zero_first | second_only, gdp).alias("gdp_per_capita"),
                F.col("industrial_activity_index").cast("double").alias(
                    "industrial_activity_index"
                ),
            )
        ).alias("text"),
    )
