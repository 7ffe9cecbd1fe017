"""The 131 assertions on raw, staging, intermediate and mart tables, as data.

Fixed values: which columns each table checks, accepted texts, predicates and severities.
"""

from __future__ import annotations

from wattlake.functions.scalar import NAMED_SECTORS, NAMED_SOURCES
from wattlake.operators.quality import ACCEPTED, EXPRESSION, NOT_NULL, UNIQUE, Check

RAW_EIA, RAW_ENRICHMENT = "raw.eia_energy_data", "raw.enrichment_data"
GENERATION = "staging.stg_eia_energy_generation"
CONSUMPTION = "staging.stg_eia_energy_consumption"
ENRICHMENT = "staging.stg_enrichment"
COMBINED = "intermediate.int_energy_combined"
FACT = "marts.fct_energy_metrics"

PERIOD_TYPES = ("daily", "monthly", "annual", "unknown")
TEMPERATURES = ("freezing", "cold", "moderate", "warm", "hot", "unknown")
POPULATIONS = ("small", "medium", "large", "very_large", "unknown")
ACTIVITIES = ("low", "normal", "high", "unknown")

REQUIRED = {
    RAW_EIA: ["id", "source", "ingestion_timestamp", "period", "location"],
    RAW_ENRICHMENT: [
        "id", "source", "ingestion_timestamp", "period", "location", "temperature_avg",
        "population", "industrial_activity_index",
    ],
    GENERATION: [
        "generation_key", "source_id", "data_source", "ingestion_timestamp", "period_date",
        "period_type", "location", "energy_source", "generation_mwh",
    ],
    CONSUMPTION: [
        "consumption_key", "source_id", "data_source", "ingestion_timestamp", "period_date",
        "period_type", "location", "consumption_mwh",
    ],
    ENRICHMENT: [
        "enrichment_key", "source_id", "data_source", "ingestion_timestamp", "period_date",
        "location", "temperature_fahrenheit", "population", "gdp_per_capita",
        "industrial_activity_index",
    ],
    COMBINED: [
        "energy_combined_key", "period_date", "location", "total_generation_mwh",
        "renewable_generation_mwh", "fossil_generation_mwh", "nuclear_generation_mwh",
        "other_generation_mwh", "energy_source_count", "renewable_percentage",
        "fossil_percentage", "has_consumption_data", "has_enrichment_data",
    ],
    FACT: [
        "metric_key", "time_key", "location_key",
        *(f"{s}_generation_mwh" for s in NAMED_SOURCES),
        "other_generation_mwh", "total_generation_mwh", "renewable_generation_mwh",
        "fossil_generation_mwh",
        *(f"{s}_consumption_mwh" for s in NAMED_SECTORS),
        "total_consumption_mwh", "renewable_percentage", "created_at", "updated_at",
    ],
}
# These two raw columns may miss with a warning only.
REQUIRED_WARN = {RAW_EIA: ["value"], RAW_ENRICHMENT: ["gdp_per_capita"]}

KEYS = {
    RAW_EIA: "id",
    RAW_ENRICHMENT: "id",
    GENERATION: "generation_key",
    CONSUMPTION: "consumption_key",
    ENRICHMENT: "enrichment_key",
    COMBINED: "energy_combined_key",
    FACT: "metric_key",
}

ACCEPTED_TEXTS = {
    RAW_EIA: {"source": ("EIA",)},
    RAW_ENRICHMENT: {"source": ("FastAPI",)},
    GENERATION: {"data_source": ("EIA",), "period_type": PERIOD_TYPES},
    CONSUMPTION: {"data_source": ("EIA",), "period_type": PERIOD_TYPES},
    ENRICHMENT: {
        "data_source": ("FastAPI",),
        "temperature_category": TEMPERATURES,
        "population_category": POPULATIONS,
        "industrial_activity_category": ACTIVITIES,
    },
    COMBINED: {"temperature_category": TEMPERATURES},
}
SCOPED_TEXTS = {COMBINED}  # checked where the column is not null

NOT_NEGATIVE, POSITIVE, PERCENT = ">= 0", "> 0", "between 0 and 100"
TEMPERATURE_RANGE = "between -50 and 150"

# column -> (predicate, severity, whether only non-null rows are in scope)
PREDICATES = {
    GENERATION: {"generation_mwh": (NOT_NEGATIVE, "warn", False)},
    CONSUMPTION: {"consumption_mwh": (NOT_NEGATIVE, "warn", False)},
    ENRICHMENT: {
        "temperature_fahrenheit": (TEMPERATURE_RANGE, "error", False),
        "population": (POSITIVE, "error", False),
        "gdp_per_capita": (POSITIVE, "warn", False),
    },
    COMBINED: {
        "total_generation_mwh": (NOT_NEGATIVE, "error", False),
        "renewable_generation_mwh": (NOT_NEGATIVE, "error", False),
        "fossil_generation_mwh": (NOT_NEGATIVE, "error", False),
        "nuclear_generation_mwh": (NOT_NEGATIVE, "error", False),
        "other_generation_mwh": (NOT_NEGATIVE, "error", False),
        "energy_source_count": (POSITIVE, "error", False),
        "renewable_percentage": (PERCENT, "error", False),
        "fossil_percentage": (PERCENT, "error", False),
        "total_consumption_mwh": (NOT_NEGATIVE, "error", True),
        "generation_to_consumption_ratio": (POSITIVE, "warn", True),
        "generation_per_capita_mwh": (POSITIVE, "warn", True),
        "consumption_per_capita_mwh": (POSITIVE, "warn", True),
    },
    FACT: {
        **{f"{s}_generation_mwh": (NOT_NEGATIVE, "error", False) for s in NAMED_SOURCES},
        "other_generation_mwh": (NOT_NEGATIVE, "error", False),
        "total_generation_mwh": (POSITIVE, "error", False),
        "renewable_generation_mwh": (NOT_NEGATIVE, "error", False),
        "fossil_generation_mwh": (NOT_NEGATIVE, "error", False),
        **{f"{s}_consumption_mwh": (NOT_NEGATIVE, "error", False) for s in NAMED_SECTORS},
        "total_consumption_mwh": (NOT_NEGATIVE, "error", False),
        "renewable_percentage": (PERCENT, "error", False),
        "avg_temperature_fahrenheit": (TEMPERATURE_RANGE, "warn", True),
        "population": (POSITIVE, "error", True),
        "gdp_per_capita_usd": (POSITIVE, "error", True),
        "industrial_activity_index": (POSITIVE, "error", True),
    },
}

FRESHNESS_HOURS = {"warn_hours": 12, "error_hours": 24}


def _scope(column: str, scoped: bool) -> str:
    return f"{column} is not null" if scoped else ""


def all_checks() -> list[Check]:
    checks = [Check(t, c, NOT_NULL) for t, columns in REQUIRED.items() for c in columns]
    checks += [
        Check(t, c, NOT_NULL, severity="warn")
        for t, columns in REQUIRED_WARN.items()
        for c in columns
    ]
    checks += [Check(t, c, UNIQUE) for t, c in KEYS.items()]
    checks += [
        Check(t, c, ACCEPTED, values=texts, where=_scope(c, t in SCOPED_TEXTS))
        for t, columns in ACCEPTED_TEXTS.items()
        for c, texts in columns.items()
    ]
    checks += [
        Check(t, c, EXPRESSION, predicate=p, severity=severity, where=_scope(c, scoped))
        for t, columns in PREDICATES.items()
        for c, (p, severity, scoped) in columns.items()
    ]
    return checks


def checks_of(*kinds: str) -> list[Check]:
    return [c for c in all_checks() if c.kind in kinds]
