"""What exists: datasets, steps, their expectations, lineage and published tables."""

from __future__ import annotations

from dataclasses import dataclass
from types import MappingProxyType

from wattlake.quality import WARN, Expectation


@dataclass(frozen=True)
class Dataset:
    name: str
    layer: str
    schema: str
    """Columns in order, as DDL; read with, so nothing is inferred from files."""
    fmt: str = "parquet"
    dated: bool = True
    """Whether its landing files lie in one folder per date."""


@dataclass(frozen=True)
class Step:
    key: str
    layer: str
    inputs: tuple[str, ...]
    outputs: tuple[str, ...]
    """The product first, side outputs after it."""
    sla_seconds: int
    expectations: tuple[Expectation, ...]
    per_date: bool = True
    """False for a dimension that is the same on every date."""

    def lineage(self) -> list[tuple[str, str]]:
        return [(up, down) for down in self.outputs for up in self.inputs]


# Schemas, limits, names and value sets that results are compared on.

READING_COLUMNS = (
    "meter_id string, reading_ts timestamp_ntz, cumulative_kwh double, voltage double, "
    "quality_flag string, src_updated_at timestamp_ntz, business_date date"
)
METER_COLUMNS = (
    "meter_id string, region string, tariff_plan string, install_date date, "
    "capacity_kw double, customer_segment string"
)
TARIFF_COLUMNS = "tariff_plan string, valid_from timestamp_ntz, price_per_kwh double, currency string"
WEATHER_COLUMNS = "region string, observed_at timestamp_ntz, temp_c double"
ACCEPTED_COLUMNS = (
    "meter_id string, reading_ts timestamp_ntz, business_date date, cumulative_kwh double, "
    "interval_kwh double, voltage double, quality_flag string, src_updated_at timestamp_ntz"
)
QUARANTINE_COLUMNS = (
    "meter_id string, reading_ts timestamp_ntz, business_date date, cumulative_kwh double, "
    "prev_kwh double, prev_ts timestamp_ntz, interval_kwh double, voltage double, reject_reason string"
)
ENRICHED_COLUMNS = (
    "meter_id string, reading_ts timestamp_ntz, business_date date, cumulative_kwh double, "
    "interval_kwh double, voltage double, quality_flag string, region string, tariff_plan string, "
    "capacity_kw double, customer_segment string, price_per_kwh double, currency string, "
    "temp_c double, cost_eur double, reading_hour timestamp_ntz, is_peak boolean"
)
DAILY_COLUMNS = (
    "business_date date, region string, meters bigint, kwh double, cost_eur double, peak_kwh double, "
    "avg_temp_c double, kwh_per_meter double, peak_share_pct double, kwh_7d_avg double, rank_in_day bigint"
)
ANOMALY_COLUMNS = (
    "meter_id string, region string, customer_segment string, business_date date, capacity_kw double, "
    "kwh double, cost_eur double, max_interval_kwh double, intervals bigint, kwh_per_kw double, "
    "z_score double, anomaly_band string, region_avg_kwh_per_kw double, region_sd_kwh_per_kw double"
)
LANDING_READING_COLUMNS = (
    "meter_id string, ts timestamp_ntz, cumulative_kwh double, voltage double, "
    "quality_flag string, src_updated_at timestamp_ntz"
)

REGIONS = ("north", "south", "east", "west", "central")
TARIFF_PLANS = ("flat", "tou", "dynamic")
BANDS = ("severe", "watch", "normal")
SPIKE_KWH = 40.0
LOW_VOLTAGE, HIGH_VOLTAGE = 180, 260
PEAK_HOURS = (17, 20)
TOP_METERS = 5

DATASETS = MappingProxyType({
    d.name: d
    for d in (
        Dataset("landing_readings", "landing", LANDING_READING_COLUMNS),
        Dataset("landing_meters", "landing", METER_COLUMNS, "csv", dated=False),
        Dataset("landing_tariffs", "landing", TARIFF_COLUMNS, "csv", dated=False),
        Dataset("landing_weather", "landing", "region string, ts timestamp_ntz, temp_c double"),
        Dataset("bronze_readings", "bronze", READING_COLUMNS),
        Dataset("bronze_meters", "bronze", METER_COLUMNS),
        Dataset("bronze_tariffs", "bronze", TARIFF_COLUMNS),
        Dataset("bronze_weather", "bronze", WEATHER_COLUMNS),
        Dataset("silver_readings", "silver", ACCEPTED_COLUMNS),
        Dataset("silver_quarantine", "silver", QUARANTINE_COLUMNS),
        Dataset("silver_enriched", "silver", ENRICHED_COLUMNS),
        Dataset("gold_daily_region", "gold", DAILY_COLUMNS),
        Dataset("gold_meter_anomalies", "gold", ANOMALY_COLUMNS),
    )
})

STEPS = MappingProxyType({
    s.key: s
    for s in (
        Step("bronze_readings", "bronze", ("landing_readings",), ("bronze_readings",), 45, (
            Expectation("row_count_min", "bronze_readings", params={"min": 1000}),
            Expectation("not_null", "bronze_readings", "meter_id"),
            Expectation("not_null", "bronze_readings", "reading_ts"),
        )),
        Step("bronze_meters", "bronze", ("landing_meters",), ("bronze_meters",), 30, (
            Expectation("unique", "bronze_meters", "meter_id"),
            Expectation("accepted_values", "bronze_meters", "region", {"values": list(REGIONS)}),
            Expectation("accepted_values", "bronze_meters", "tariff_plan", {"values": list(TARIFF_PLANS)}),
        ), per_date=False),
        Step("bronze_tariffs", "bronze", ("landing_tariffs",), ("bronze_tariffs",), 30, (
            Expectation("row_count_min", "bronze_tariffs", params={"min": 3}),
            Expectation("between", "bronze_tariffs", "price_per_kwh", {"min": 0.0, "max": 5.0},
                        name="tariff_price_sane"),
            Expectation("unique", "bronze_tariffs", params={"columns": ["tariff_plan", "valid_from"]}),
        ), per_date=False),
        Step("bronze_weather", "bronze", ("landing_weather",), ("bronze_weather",), 30, (
            Expectation("between", "bronze_weather", "temp_c", {"min": -50, "max": 60}),
        )),
        Step("silver_cleanse", "silver", ("bronze_readings",), ("silver_readings", "silver_quarantine"), 90, (
            Expectation("row_count_min", "silver_readings", params={"min": 500}),
            Expectation("unique", "silver_readings", params={"columns": ["meter_id", "reading_ts"]}),
            Expectation("not_null", "silver_readings", "interval_kwh"),
            Expectation("between", "silver_readings", "interval_kwh", {"min": 0, "max": 500}),
            Expectation("reject_rate_max", "silver_quarantine",
                        params={"max": 0.08, "against": "bronze_readings"},
                        severity=WARN, name="quarantine_rate"),
        )),
        Step("silver_enrich", "silver",
             ("silver_readings", "bronze_meters", "bronze_tariffs", "bronze_weather"),
             ("silver_enriched",), 120, (
            Expectation("not_null", "silver_enriched", "price_per_kwh"),
            Expectation("not_null", "silver_enriched", "region"),
            Expectation("not_null", "silver_enriched", "cost_eur"),
            Expectation("sum_close_to", "silver_enriched",
                        params={"column": "interval_kwh", "against": "silver_readings",
                                "against_column": "interval_kwh", "tolerance": 0.001},
                        name="enrich_preserves_volume"),
            Expectation("referential", "silver_enriched", "meter_id",
                        {"parent": "bronze_meters", "parent_column": "meter_id"}),
        )),
        Step("gold_daily_region", "gold", ("silver_enriched",), ("gold_daily_region",), 60, (
            Expectation("row_count_min", "gold_daily_region", params={"min": 1}),
            Expectation("unique", "gold_daily_region", params={"columns": ["business_date", "region"]}),
            Expectation("between", "gold_daily_region", "peak_share_pct", {"min": 0, "max": 100}),
            Expectation("sum_close_to", "gold_daily_region",
                        params={"column": "kwh", "against": "silver_enriched",
                                "against_column": "interval_kwh", "tolerance": 0.01},
                        name="gold_reconciles_to_silver"),
        )),
        Step("gold_meter_anomalies", "gold", ("silver_enriched",), ("gold_meter_anomalies",), 60, (
            Expectation("unique", "gold_meter_anomalies", params={"columns": ["business_date", "meter_id"]}),
            Expectation("accepted_values", "gold_meter_anomalies", "anomaly_band", {"values": list(BANDS)}),
            Expectation("row_count_max", "gold_meter_anomalies", params={"max": 100000}, severity=WARN),
        )),
    )
})

#: Steps of a phase are independent of each other; phases run in order.
PHASES = (
    ("bronze", ("bronze_readings", "bronze_meters", "bronze_tariffs", "bronze_weather")),
    ("cleanse", ("silver_cleanse",)),
    ("enrich", ("silver_enrich",)),
    ("gold", ("gold_daily_region", "gold_meter_anomalies")),
)

PUBLISHED = MappingProxyType({
    "gold_daily_region": "gold.daily_region_consumption",
    "gold_meter_anomalies": "gold.meter_anomalies",
})

# End of the fixed values.
