"""From API pages and records to raw-layer rows."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattlake import schemas

_PAGE = "response struct<data: array<string>>"
_MONTH_PARAMETER = r"^\d{4}-\d{2}$"

#: Why a record is not landed.
MALFORMED, NO_NUMBER, OUT_OF_RANGE = "malformed JSON", "no number", "out of range"
#: Numbers are parsed as wide decimals, then cast to their field's type.
_WIDE = "decimal(38,18)"
_CORRUPT = "_corrupt_record"
#: Columns that reading a record adds to its fields: told apart from any field by the blank.
_HAS_LOCATION, _REASON, _ROUNDED = "has location", "reject reason", "is rounded"


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """One row for each page file. A page holds at most the 5,000 records of one request."""
    return spark.read.text(path, wholetext=True)


def unwrap_pages(pages: DataFrame, value: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Records of ``{"response": {"data": [...]}}`` pages, each as its original JSON text.

    A page without that envelope gives no rows.
    """
    data = F.from_json(F.col(value), _PAGE).getField("response").getField("data")
    return pages.select(*keep, F.explode(data).alias("raw_json"))


def records_of_pages(pages: DataFrame, value: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Record texts of pages as ``raw_json``, each as it came.

    A page without the envelope gives no rows. A page that is no JSON object gives itself as one
    text, for the quarantine.
    """
    page = F.from_json(F.col(value), f"{_PAGE}, {_CORRUPT} string", {"columnNameOfCorruptRecord": _CORRUPT})
    parsed = F.col("`page as parsed`")
    broken = (parsed.isNull() | parsed[_CORRUPT].isNotNull()) & F.col("`page as sent`").isNotNull()
    texts = F.when(broken, F.array("`page as sent`")).otherwise(parsed["response"]["data"])
    return pages.select(*keep, F.col(value).alias("page as sent"), page.alias("page as parsed")).select(
        *keep, F.explode(texts).alias("raw_json")
    )


def records_of_lines(lines: DataFrame, value: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Record texts as they came, one a row."""
    return lines.select(*keep, F.col(value).alias("raw_json"))


def read_fields(records: DataFrame, schema: T.StructType, keep: Sequence[str] = ()) -> DataFrame:
    """Typed fields of record texts by one parse, with the marks by which rejects are told.

    A text is rejected if it is no JSON object, or if a number's field holds something that is no
    number or lies outside of the field's type. A number with more decimals than the type has is
    rounded and marked; the text keeps it as it came. Absent fields and explicit nulls are NULL;
    the location is read as VARIANT, which tells these two apart.
    """
    numbers = [f for f in schema.fields if not isinstance(f.dataType, T.StringType)]
    kinds = {f.name: _WIDE if f in numbers else "string" for f in schema.fields}
    kinds |= {"location": "variant", _CORRUPT: "string"}
    declared = ", ".join(f"`{name}` {kind}" for name, kind in kinds.items())
    parsed = F.from_json(F.col("raw_json"), declared, {"columnNameOfCorruptRecord": _CORRUPT})
    read = records.select(*keep, "raw_json", parsed.alias("record as sent")).select(
        *keep,
        "raw_json",
        "`record as sent`",
        *(F.col("`record as sent`")[f.name].try_cast(f.dataType).alias(f.name) for f in numbers),
    )
    is_object = F.startswith(F.ltrim("raw_json"), F.lit("{")) & F.try_parse_json("raw_json").isNotNull()
    outside, rounded = F.lit(False), F.lit(False)
    reason = F.when(~F.coalesce(is_object, F.lit(False)), F.lit(MALFORMED))
    for f in numbers:
        wide, value = F.col("`record as sent`")[f.name], F.col(f"`{f.name}`")
        outside |= wide.isNotNull() & value.isNull()
        rounded |= F.coalesce(value != wide, F.lit(False))
        # Looked at for rejects only, one by one.
        text = F.try_variant_get(F.try_parse_json("raw_json"), f"$['{f.name}']", "string")
        wrong = F.when(text.try_cast("double").isNotNull(), F.lit(f"{f.name}: {OUT_OF_RANGE}")).otherwise(F.lit(f"{f.name}: {NO_NUMBER}"))
        reason = reason.when(value.isNull() & text.isNotNull(), wrong)
    doubtful = (
        F.col("`record as sent`").isNull() | F.col("`record as sent`")[_CORRUPT].isNotNull() | outside
        | ~F.startswith(F.ltrim("raw_json"), F.lit("{"))
    )
    texts = {n: F.col("`record as sent`")[n] for n in schema.fieldNames() if schema[n] not in numbers}
    texts["location"] = F.try_variant_get(F.col("`record as sent`")["location"], "$", "string")
    return read.select(
        *keep,
        "raw_json",
        *(texts[n].alias(n) if n in texts else F.col(f"`{n}`") for n in schema.fieldNames()),
        F.col("`record as sent`")["location"].isNotNull().alias(_HAS_LOCATION),
        F.when(doubtful, F.coalesce(reason, F.lit(MALFORMED))).alias(_REASON),
        rounded.alias(_ROUNDED),
    )


def with_raw_json(table: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Add the whole row as JSON text, NULL fields included, to input that is tabular already."""
    fields = F.struct(*(columns or table.columns))
    return table.withColumn("raw_json", F.to_json(fields, {"ignoreNullFields": "false"}))


def _series_id() -> Column:
    """``seriesId``, or one made of the location where it is missing, null or empty.

    A record without a location key gets NA, one with an explicit null the text None.
    """
    place = F.coalesce(
        F.col("location"),
        F.when(F.col(f"`{_HAS_LOCATION}`"), F.lit("None")).otherwise(F.lit("NA")),
    )
    return F.when(
        F.coalesce(F.col("seriesId"), F.lit("")) != "", F.col("seriesId")
    ).otherwise(F.concat(F.lit("ELEC.GEN."), place))


def map_eia_records(
    records: DataFrame, ingested_at: Column | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """Raw-layer columns from the fields of EIA records of either naming family.

    Only NULL falls through to the second name: a 0 or an empty text is a value.
    """
    return records.select(
        *keep,
        *stamp("EIA", ingested_at),
        _series_id().alias("series_id"),
        F.col("period"),
        F.coalesce("value", "generation").alias("value"),
        F.coalesce(F.col("units"), F.col("`generation-units`")).alias("units"),
        F.col("location"),
        F.coalesce("locationType", "stateDescription").alias("location_type"),
        F.coalesce("energySource", "fuelTypeDescription").alias("energy_source"),
        F.coalesce("sector", "sectorDescription").alias("sector"),
        F.col("raw_json"),
    )


def map_enrichment_records(
    records: DataFrame, ingested_at: Column | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """Raw-layer columns from the fields of enrichment records.

    A GDP of 0 under the first name falls through to the second one, as NULL does.
    """
    temperature = F.col("temperature_fahrenheit")
    gdp = F.when(
        F.coalesce(F.col("gdp_per_capita_usd"), F.lit(0)) != 0, F.col("gdp_per_capita_usd")
    ).otherwise(F.col("gdp_per_capita"))
    return records.select(
        *keep,
        *stamp("FastAPI", ingested_at),
        F.col("period"),
        F.col("location"),
        temperature.alias("temperature_avg"),
        F.when(temperature.isNotNull(), F.lit("fahrenheit")).alias("temperature_unit"),
        F.col("population"),
        gdp.alias("gdp_per_capita"),
        F.col("industrial_activity_index"),
        F.col("raw_json"),
    )


def stamp(source: str, ingested_at: Column | None = None) -> list[Column]:
    """Source name and time of ingestion."""
    when = F.current_timestamp() if ingested_at is None else ingested_at
    return [F.lit(source).alias("source"), when.cast("timestamp_ntz").alias("ingestion_timestamp")]


#: A family of records: fields, mapping to raw columns, and columns that must not be blank.
_FAMILIES = {
    "eia": (schemas.EIA_RECORD, map_eia_records, ()),
    "enrichment": (schemas.ENRICHMENT_RECORD, map_enrichment_records, ("location", "period")),
}


def mark(
    records: DataFrame, family: str, keep: Sequence[str] = (), ingested_at: Column | None = None
) -> DataFrame:
    """Raw-layer columns of records with ``reject_reason`` (NULL: a row to land) and ``is_rounded``.

    The columns of a reject are NULL but for source, time and text. Enrichment records also need
    a location and a period that are not blank, and get them trimmed.
    """
    schema, mapping, required = _FAMILIES[family]
    fields = read_fields(records, schema, keep).withColumnsRenamed(
        {_REASON: "reject_reason", _ROUNDED: "is_rounded"}
    )
    also = [*keep, "reject_reason", "is_rounded"]
    if required:
        trimmed = split_by_required_text(fields.withColumnRenamed("reject_reason", "unread"), required)
        fields = trimmed.withColumn("reject_reason", F.coalesce("unread", "reject_reason"))
    mapped = mapping(fields, ingested_at, keep=also)
    stays = {*also, "source", "ingestion_timestamp", "raw_json"}
    return mapped.withColumns(
        {c: F.when(F.col("reject_reason").isNull(), F.col(c)) for c in mapped.columns if c not in stays}
    )


def _landed(marked: DataFrame) -> DataFrame:
    """Rows without a reason. Not a filter: the optimiser would send it down to the texts, and
    with it a second parsing of every record."""
    columns = [f"`{c}`" for c in marked.columns if c not in ("reject_reason", "is_rounded")]
    one = F.array(F.struct(*columns))
    return marked.select(F.inline(F.when(F.col("reject_reason").isNull(), one)))


def land_eia_pages(pages: DataFrame, keep: Sequence[str] = (), **options) -> DataFrame:
    """Raw rows of all records that can be landed; ``land_batch`` keeps the rejects as well."""
    return _landed(mark(records_of_pages(pages, keep=keep), "eia", keep, **options))


def land_eia_lines(
    lines: DataFrame, value: str = "value", keep: Sequence[str] = (), **options
) -> DataFrame:
    """Single records, one JSON text each, through the same mapping as a page."""
    return _landed(mark(records_of_lines(lines, value, keep), "eia", keep, **options))


def land_enrichment_lines(
    lines: DataFrame, value: str = "value", keep: Sequence[str] = (), **options
) -> DataFrame:
    return _landed(mark(records_of_lines(lines, value, keep), "enrichment", keep, **options))


def land_batch(marked: DataFrame, path: str) -> dict[str, int]:
    """Write marked records to two sinks in one pass and return their numbers.

    Rows go to ``path``/rejected=false, rejects to ``path``/rejected=true, by one job that one
    Observation counts: landed, rejected, rounded. A batch without records writes no data.
    """
    rejected = F.col("reject_reason").isNotNull()
    seen = Observation()
    counted = marked.observe(
        seen,
        F.count_if(~rejected).alias("landed"),
        F.count_if(rejected).alias("rejected"),
        F.count_if("is_rounded").alias("rounded"),
    )
    counted.withColumn("rejected", rejected).write.mode("append").partitionBy("rejected").parquet(path)
    return seen.get


def read_landed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Raw rows of a table that land_batch writes; the reader skips the folder of rejects."""
    whole = T.StructType([*schema.fields, T.StructField("rejected", T.BooleanType())])
    return spark.read.schema(whole).parquet(path).where("NOT rejected").drop("rejected")


def read_quarantine(spark: SparkSession, path: str, keep: Sequence[str] = ()) -> DataFrame:
    """Rejects of a table that land_batch writes: source, time, reason and text."""
    return spark.read.parquet(path).where("rejected = 'true'").select(
        *keep, "source", "ingestion_timestamp", "reject_reason", "raw_json"
    )


def retry_quarantine(
    spark: SparkSession, path: str, family: str, keep: Sequence[str] = (), repair: Column | None = None
) -> DataFrame:
    """Rejects marked once more, say after a repair of their texts (an expression on raw_json)."""
    rejects = read_quarantine(spark, path, keep)
    text = F.col("raw_json") if repair is None else repair
    return mark(records_of_lines(rejects.withColumn("value", text), keep=keep), family, keep)


def require_month(bound: str) -> str:
    """A period bound given as a parameter: YYYY-MM or an error."""
    if not re.match(_MONTH_PARAMETER, bound):
        raise ValueError(f"not a month (YYYY-MM): {bound!r}")
    return bound


def split_by_month_format(table: DataFrame, period: str = "period") -> DataFrame:
    """Mark each row whether its period is a YYYY-MM one, with the reason of a reject."""
    valid = F.coalesce(F.col(period).rlike(_MONTH_PARAMETER), F.lit(False))
    reason = F.when(F.col(period).isNull(), "missing period").otherwise("expected YYYY-MM")
    return table.withColumns({"is_valid": valid, "reject_reason": F.when(~valid, reason)})


def split_by_required_text(table: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Trim the columns and mark each row whether all of them are non-empty."""
    trimmed = table.withColumns({c: F.trim(F.col(c)) for c in columns})
    missing = [
        F.when(F.coalesce(F.length(F.col(c)), F.lit(0)) == 0, F.lit(c)) for c in columns
    ]
    reason = F.concat_ws(",", *missing)
    return trimmed.withColumns(
        {
            "is_valid": reason == "",
            "reject_reason": F.when(
                reason != "", F.concat(reason, F.lit(" must not be blank"))
            ),
        }
    )


def append_batch(batch: DataFrame, path: str, partition_by: Sequence[str] = ()) -> int:
    """Append rows to a Parquet table and return their number; nothing is written for none.

    The count comes from the write itself, so the batch is computed once.
    """
    if batch.isEmpty():
        return 0
    written = Observation()
    counted = batch.observe(written, F.count(F.lit(1)).alias("rows"))
    counted.write.mode("append").partitionBy(*partition_by).parquet(path)
    return written.get["rows"]
