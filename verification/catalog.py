"""Every registered query: its Spark form over the given tables and its SQL counterpart."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pampero import files
from pampero.functions.calendar import with_calendar
from pampero.functions.text import normalize_text
from pampero.operators import checks, incremental, monthly
from pampero.operators.payload import raw_member, with_payload
from pampero.operators.ranking import best_row, newest
from pampero.plans import dimensions, legacy, marts, staging, suite, weather
from pampero.plans.models import Models, lazy, locations_only
from pampero.session import prepare
from pampero.sinks import bucketed, catalogue
from pampero.sinks import export as exporting
from pampero.sinks import tables
from pampero.sources import adapter, raw, schemas, windows
from pampero.sources.schemas import MEASURES, REPLICATION
from pampero.streaming import upsert as streaming
from pampero.workspace import new_path, release, stage
from verification import oracles as sql

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query under a name, with the SQL it is compared with."""

    def register(run: Query) -> Query:
        def presented(spark: SparkSession, sf_dir: str) -> DataFrame:
            return _present(run(prepare(spark), sf_dir))

        QUERIES[name] = presented
        if oracle:
            ORACLES[name] = oracle
        return run

    return register


def _present(df: DataFrame) -> DataFrame:
    """Cut what depends on summation order or the maths library; show timestamps as UTC."""

    def column(f: T.StructField):
        value = F.col(f.name)
        if f.name in sql.ROUNDED:
            value = F.floor(value * 1e6 + sql.CUT) / 1e6
        elif isinstance(f.dataType, T.TimestampType):
            value = value.cast("timestamp_ntz")
        return value.alias(f.name)

    return df.select([column(f) for f in df.schema])


def _models(spark: SparkSession, d: str, form: str = "flat", keep=stage) -> Models:
    """Model graph over the derived sources; CSV files are written when first needed."""
    return Models(
        lambda: adapter.raw_weather(spark, d, form),
        lambda: adapter.raw_locations(spark, d, "json" if form == "json" else "struct"),
        lambda: adapter.tax_csv(spark, d),
        lambda: adapter.yield_csv(spark, d),
        keep=keep,
    )


def _plan(spark: SparkSession, d: str, form: str = "flat") -> Models:
    """The same without stored relations, for queries that read each relation once."""
    return _models(spark, d, form, keep=lazy)


DAY = ["location_id", "date"]
STG_WEATHER = [
    "location_id",
    "location_name",
    "province_name",
    "province_key",
    "latitude",
    "longitude",
    "date",
    "source_name",
    "source_type",
    "source_loaded_at",
    *MEASURES,
    *REPLICATION,
]

# --- sources ----------------------------------------------------------------------------


@query("stg_locations", sql.select("stg_loc", [*sql.LOCATION_COLUMNS, *REPLICATION]))
def _(spark, d):
    return _models(spark, d, "json").stg_locations


@query("stg_locations_struct", sql.select("stg_loc", [*sql.LOCATION_COLUMNS, *REPLICATION]))
def _(spark, d):
    return _plan(spark, d).stg_locations


@query("stg_weather_daily", sql.select("stg", STG_WEATHER))
def _(spark, d):
    return _models(spark, d, "json").stg_weather


@query("stg_weather_daily_struct", sql.select("stg", STG_WEATHER))
def _(spark, d):
    return _plan(spark, d, "struct").stg_weather


@query("stg_weather_daily_variant", sql.select("stg", STG_WEATHER))
def _(spark, d):
    """The payload stored as VARIANT; members are fetched by their paths."""
    path = new_path(spark, "raw")
    adapter.raw_weather(spark, d, "variant").write.parquet(path)
    return staging.weather(spark.read.parquet(path))


@query("stg_weather_daily_flat", sql.select("stg", STG_WEATHER))
def _(spark, d):
    return _plan(spark, d).stg_weather


TAX = ["province_name", "province_key", *[c for c in sql.TAXES if not c.endswith("spread")]]


@query("stg_tax", sql.select("tax", TAX))
def _(spark, d):
    return staging.tax(adapter.tax_csv(spark, d))


STG_YIELD = [
    "crop_name",
    "crop_key",
    "harvest_year",
    "campaign_name",
    "campaign_start_year",
    "campaign_end_year",
    "province_name",
    "province_key",
    "province_id",
    "department_name",
    "department_key",
    "department_id",
    "sown_area_ha",
    "harvested_area_ha",
    "production_tonnes",
    "yield_kg_ha",
]


@query("stg_yield", sql.select("stg_yields", STG_YIELD))
def _(spark, d):
    return staging.yields(adapter.yield_csv(spark, d))


@query(
    "catalog_locations",
    sql.chain("located")
    + f"""SELECT 'cat_' || s AS location_id, 'Estación ' || s AS location_name,
    n_name AS province_name, {sql.norm("n_name")} AS province_key,
    CAST(-21 - (s % 340) / 10e0 AS DOUBLE) AS latitude,
    CAST(-54 - (s % 170) / 10e0 AS DOUBLE) AS longitude, 'AR' AS country_code,
    s % 4 <> 0 AS is_active, TIMESTAMP '2002-01-01 00:00:00' AS record_loaded_at FROM located""",
)
def _(spark, d):
    current = dimensions.current_locations(staging.locations(adapter.catalog_raw(spark, d)))
    return current.select(
        "location_id",
        "location_name",
        "province_name",
        "province_key",
        "latitude",
        "longitude",
        "country_code",
        "is_active",
        "record_loaded_at",
    )


@query(
    "legacy_stg_locations",
    sql.select(
        "stg_loc",
        [
            *REPLICATION,
            "location_id",
            "location_name",
            "province_name",
            "latitude",
            "longitude",
            "country_code",
            "is_active",
        ],
    ),
)
def _(spark, d):
    return staging.legacy_locations(adapter.raw_locations(spark, d, "json"))


@query(
    "legacy_stg_weather",
    sql.chain("flat")
    + f"""SELECT {", ".join(REPLICATION)}, location_id, date, x_source, x_source_type,
    loaded_at AS x_loaded_at, {", ".join(sql.LEGACY_MEASURES)} FROM flat""",
)
def _(spark, d):
    return staging.legacy_weather(adapter.raw_weather(spark, d))


FIRST_LOAD = "_sdc_extracted_at < TIMESTAMP '2001-01-01 00:00:00'"


@query(
    "incremental_scan",
    sql.chain("flat")
    + f"""SELECT location_id, raw_date AS date, _sdc_extracted_at, _sdc_sequence FROM flat
WHERE _sdc_extracted_at > (SELECT max(_sdc_extracted_at) FROM flat WHERE {FIRST_LOAD})""",
)
def _(spark, d):
    source = adapter.observations(spark, d)
    fresh = incremental.new_rows(source, source.filter(FIRST_LOAD), "_sdc_extracted_at")
    return fresh.select(*DAY, "_sdc_extracted_at", "_sdc_sequence")


def _date_span(df: DataFrame):
    """First and last date of a relation: one row reaches the driver."""
    return df.agg(F.min("date"), F.max("date")).first()


@query(
    "window_days_back",
    sql.chain("live")
    + """SELECT location_id, date, _sdc_sequence, precipitation_mm FROM live
WHERE date >= (SELECT max(date) FROM live) - 30 AND date < (SELECT max(date) FROM live)""",
)
def _(spark, d):
    live = weather.live_rows(_plan(spark, d).stg_weather)
    first, last = windows.days_back(30, today=_date_span(live)[1])
    return windows.date_window(live, first, last).select(
        *DAY, "_sdc_sequence", "precipitation_mm"
    )


@query(
    "window_year_slices",
    sql.chain("live")
    + """SELECT CAST(date_trunc('year', date) AS DATE) AS slice_start, count(*) AS row_count,
    count(DISTINCT location_id) AS location_count, sum(precipitation_mm) AS precipitation_mm
FROM live GROUP BY 1""",
)
def _(spark, d):
    live = weather.live_rows(_plan(spark, d).stg_weather)
    first, last = _date_span(live)
    slices = windows.year_slices(first.year, last.year - 1, tail_end=last)
    return (
        windows.with_slice(live, slices)
        .groupBy("slice_start")
        .agg(
            F.count("*").alias("row_count"),
            F.count_distinct("location_id").alias("location_count"),
            F.sum("precipitation_mm").alias("precipitation_mm"),
        )
    )


@query(
    "event_payloads",
    """WITH payloads AS (SELECT event_id, user_id, CAST(ts AS DATE) AS date, event_type, ts,
    CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)
SELECT user_id, date, event_id, event_type, k FROM (SELECT *, row_number() OVER (
    PARTITION BY user_id, date ORDER BY k DESC NULLS LAST, ts DESC, event_id DESC) AS rn FROM payloads)
WHERE rn = 1""",
)
def _(spark, d):
    raw = adapter.table(spark, d, "events").withColumnRenamed("props", "data")
    parsed = with_payload(raw, T.StructType([T.StructField("k", T.StringType())]))
    typed = parsed.select(
        "event_id",
        "user_id",
        F.to_date("ts").alias("date"),
        "event_type",
        "ts",
        raw_member("k").try_cast("bigint").alias("k"),
    )
    best = best_row(typed, ["user_id", "date"], newest("k", "ts"), ["event_id"])
    return best.drop("ts")


# --- projections and filters ------------------------------------------------------------

SNAPSHOT_KEY = [*DAY, "_sdc_sequence", "_sdc_extracted_at"]


@query("record_loaded_at", sql.select("live", [*SNAPSHOT_KEY, "record_loaded_at"]))
def _(spark, d):
    live = weather.live_rows(_plan(spark, d).stg_weather)
    return live.select(*SNAPSHOT_KEY, weather.record_loaded_at().alias("record_loaded_at"))


@query("non_null_count", sql.select("live", [*SNAPSHOT_KEY, "weather_variable_non_null_count"]))
def _(spark, d):
    rows = weather.counted_rows(_plan(spark, d).stg_weather)
    return rows.select(*SNAPSHOT_KEY, "weather_variable_non_null_count")


@query("soft_delete", sql.select("live", SNAPSHOT_KEY))
def _(spark, d):
    return weather.live_rows(_plan(spark, d).stg_weather).select(*SNAPSHOT_KEY)


@query("tax_spread", sql.select("tax", ["province_name", "province_key", *sql.TAXES]))
def _(spark, d):
    return _plan(spark, d).tax


@query(
    "normalize_text",
    f"""SELECT c_custkey, {sql.norm("raw")} AS text_key FROM (SELECT c_custkey,
    chr(9) || ' ' || lower(c_mktsegment) || '  ñandú  Ü' || chr(10) || c_name || ' ' AS raw
    FROM customer)""",
)
def _(spark, d):
    raw = F.concat(
        F.lit("\t "), F.lower("c_mktsegment"), F.lit("  ñandú  Ü\n"), F.col("c_name"), F.lit(" ")
    )
    customers = adapter.table(spark, d, "customer")
    return customers.select("c_custkey", normalize_text(raw).alias("text_key"))


# --- daily weather ----------------------------------------------------------------------


def _best(spark, d) -> DataFrame:
    return weather.best_daily_rows(_plan(spark, d).stg_weather)


DEDUPED = [
    *[c for c in STG_WEATHER if c != "_sdc_table_version"],
    "record_loaded_at",
    "weather_variable_non_null_count",
]


@query("weather_dedup", sql.select("best", DEDUPED))
def _(spark, d):
    return _best(spark, d).select(*DEDUPED)


@query("weather_daily_base", sql.select("base", sql.BASE_COLUMNS))
def _(spark, d):
    return _plan(spark, d).weather_base


@query("campaign_calendar", sql.select("dated", [*DAY, *sql.CALENDAR]))
def _(spark, d):
    return with_calendar(_best(spark, d)).select(*DAY, *sql.CALENDAR)


def _metric(name: str, column: str) -> None:
    @query(name, sql.select("metrics", [*DAY, column]))
    def _(spark, d):
        return _best(spark, d).select(*DAY, weather.METRICS[column]().alias(column))


_metric("temp_range", "temp_range_c")
_metric("radiation_gap", "clear_sky_radiation_gap_mj_m2_day")
_metric("heat_index", "heat_index_c")
_metric("wind_chill", "wind_chill_c")
_metric("vpd", "vpd_kpa")
_metric("gdd", "gdd_base_10_c_days")

METRICS_TABLE = [*sql.BASE_COLUMNS, *sql.CALENDAR, *sql.METRICS]


@query("weather_daily_metrics", sql.select("metrics", METRICS_TABLE))
def _(spark, d):
    return _plan(spark, d).weather_metrics


@query("critical_null_count", sql.select("quality", [*DAY, "critical_null_count"]))
def _(spark, d):
    return weather.with_quality_flags(_best(spark, d)).select(*DAY, "critical_null_count")


@query("quality_flags", sql.select("quality", [*DAY, *sql.FLAGS]))
def _(spark, d):
    return weather.with_quality_flags(_best(spark, d)).select(*DAY, *sql.FLAGS)


@query("quality_approved", sql.select("quality", [*DAY, "is_quality_approved"]))
def _(spark, d):
    flagged = weather.with_quality_flags(_best(spark, d))
    return flagged.select(*DAY, weather.approved().alias("is_quality_approved"))


@query("risk_flags", sql.select("quality", [*DAY, *sql.RISKS]))
def _(spark, d):
    return _best(spark, d).withColumns(weather.climate.risk_flags()).select(*DAY, *sql.RISKS)


@query("partial_latest_day", sql.select("partial", [*DAY, "is_partial_latest_day"]))
def _(spark, d):
    staged = _plan(spark, d).stg_weather
    flagged = weather.with_quality_flags(weather.best_daily_rows(staged))
    marked = weather.with_partial_latest_day(flagged, weather.latest_day(staged))
    return marked.select(*DAY, "is_partial_latest_day")


QUALITY_TABLE = [
    *METRICS_TABLE,
    "critical_null_count",
    *sql.FLAGS,
    *sql.RISKS,
    "is_partial_latest_day",
    "is_quality_approved",
]


@query("weather_daily_quality", sql.select("partial", QUALITY_TABLE))
def _(spark, d):
    return _plan(spark, d).weather_quality


# --- dimensions, facts, marts -----------------------------------------------------------

LOCATION_TABLE = [*sql.LOCATION_COLUMNS, "record_loaded_at"]


@query("location_current", sql.select("current", [*LOCATION_TABLE, *REPLICATION]))
def _(spark, d):
    return _plan(spark, d).current_locations


@query(
    "weather_only_locations",
    sql.select("dim_loc", LOCATION_TABLE, where="NOT is_catalog_location"),
)
def _(spark, d):
    return _plan(spark, d).weather_only


@query("dim_location", sql.select("dim_loc", [*LOCATION_TABLE, "is_catalog_location"]))
def _(spark, d):
    return _plan(spark, d).dim_location


COVERAGE = ["has_weather_data", "has_tax_data", "has_yield_data"]


@query("province_coverage", sql.select("coverage", ["province_key", *COVERAGE]))
def _(spark, d):
    return dimensions.province_coverage(_plan(spark, d).province_mentions)


@query("dim_province", sql.select("dim_prov", ["province_key", "province_name", *COVERAGE]))
def _(spark, d):
    return _plan(spark, d).dim_province


@query("fct_weather_daily", sql.select("fact", QUALITY_TABLE))
def _(spark, d):
    return _models(spark, d).fct_weather


@query("fct_tax_province", sql.select("fct_tax", ["province_name", "province_key", *sql.TAXES]))
def _(spark, d):
    return _plan(spark, d).fct_tax


YIELD_TABLE = [
    "crop_name",
    "crop_key",
    "campaign_name",
    "campaign_start_year",
    "campaign_end_year",
    "harvest_year",
    "province_name",
    "province_key",
    *marts.YIELD_MEASURES,
]


@query("yield_province_campaign", sql.select("yields", YIELD_TABLE))
def _(spark, d):
    return _plan(spark, d).yields


@query("fct_yield_province_campaign", sql.select("fct_yield", YIELD_TABLE))
def _(spark, d):
    return _plan(spark, d).fct_yield


CAMPAIGN_KEY = ["province_key", "campaign_name", "campaign_start_year"]


@query("weather_by_campaign", sql.select("campaigns", [*CAMPAIGN_KEY, *marts.CAMPAIGN_WEATHER]))
def _(spark, d):
    return _models(spark, d).campaign_weather


MART = [
    *YIELD_TABLE,
    *marts.CAMPAIGN_WEATHER,
    *sql.TAXES,
    "usable_weather_day_ratio",
    "has_weather_campaign_data",
    "has_tax_data",
]


@query("mart_province_campaign", sql.select("mart", MART))
def _(spark, d):
    return _models(spark, d, "json").mart_province_campaign


SCORES = [
    "climate_rain_signal",
    "climate_water_stress_signal",
    "climate_temperature_signal",
    "climate_index_total",
]


@query("snapshot_rank", sql.select("chosen", [*DAY, "selection_strategy", "_sdc_sequence"]))
def _(spark, d):
    chosen = marts.snapshot_rows(_models(spark, d).weather_quality)
    return chosen.select(*DAY, "selection_strategy", "_sdc_sequence")


@query(
    "climate_scores",
    sql.chain("all_scored", steps=sql.with_scores("all_scored", "partial"))
    + f"SELECT location_id, date, {', '.join(SCORES)} FROM all_scored",
)
def _(spark, d):
    """Scores of every day, not only of the days picked for the snapshot."""
    models = _plan(spark, d)
    best = models.best_weather.withColumns({n: make() for n, make in weather.METRICS.items()})
    return marts.with_climate_scores(
        best.withColumns(weather.climate.risk_flags())
    ).select(*DAY, *SCORES)


SNAPSHOT = [
    "location_id",
    "location_name",
    "province_name",
    "province_key",
    "latitude",
    "longitude",
    "country_code",
    "is_active",
    "department_name",
    "department_key",
    "municipality_name",
    "elevation_m",
    "source_catalog",
    "source_type",
    "source_name",
    "source_loaded_at",
    "record_loaded_at",
    "snapshot_date",
    "campaign_name",
    "is_catalog_location",
    "has_location_dimension",
    "weather_variable_non_null_count",
    "critical_null_count",
    *sql.FLAGS,
    "is_quality_approved",
    "is_partial_latest_day",
    "selection_strategy",
    *MEASURES,
    *sql.METRICS,
    *sql.RISKS,
    *SCORES,
    "_sdc_received_at",
    "_sdc_extracted_at",
    "_sdc_sequence",
]


@query("location_snapshot", sql.select("snapshot", SNAPSHOT))
def _(spark, d):
    return _models(spark, d).location_snapshot


# --- first generation -------------------------------------------------------------------


def _flat(spark, d) -> DataFrame:
    return adapter.observations(spark, d)


EXTRACT = ["location_id", "date", "_sdc_extracted_at", "_sdc_sequence"]


@query(
    "legacy_dedup",
    sql.chain("extracts")
    + "SELECT location_id, raw_date AS date, _sdc_extracted_at, _sdc_sequence FROM extracts",
)
def _(spark, d):
    return legacy.newest_extracts(_flat(spark, d)).select(*EXTRACT)


def _legacy(name: str, columns: list[str]) -> None:
    @query(name, sql.select("legacy_daily", [*EXTRACT, *columns]))
    def _(spark, d):
        return legacy.daily(_flat(spark, d)).select(*EXTRACT, *columns)


_legacy("legacy_metrics", sql.LEGACY_DERIVED[:4])
_legacy("legacy_risk_flags", sql.LEGACY_DERIVED[4:10])
_legacy("legacy_quality", sql.LEGACY_DERIVED[10:])


@query("legacy_daily", sql.select("legacy_daily", sql.LEGACY_COLUMNS))
def _(spark, d):
    return legacy.daily(_flat(spark, d))


# --- incremental loading ----------------------------------------------------------------


def _order_number(df: DataFrame):
    return F.floor(df["_sdc_sequence"] / 10)


@query(
    "incremental_upsert",
    sql.chain("legacy_daily", "corr_daily", steps=sql.with_corrections())
    + f"""SELECT {sql.columns(sql.LEGACY_COLUMNS)} FROM legacy_daily
ANTI JOIN corr_daily USING (location_id, date)
UNION ALL SELECT {sql.columns(sql.LEGACY_COLUMNS)} FROM corr_daily""",
)
def _(spark, d):
    """First load, increment, the same increment again, then corrections mixed with late rows."""
    source, table = adapter.observations(spark, d), new_path(spark, "daily")
    mark, cluster_by = "_sdc_extracted_at", streaming.CLUSTER_BY

    def load(rows: DataFrame) -> None:
        incremental.load_new(rows, table, mark, legacy.daily, legacy.KEY, cluster_by)

    load(source.filter(FIRST_LOAD))
    load(source)
    load(source)
    order = _order_number(source)
    corrected = source.filter((F.year(mark) == 2000) & (F.pmod(order, F.lit(50)) == 0))
    late = source.filter(F.pmod(order, F.lit(51)) == 0)
    load(
        corrected.withColumns(
            {mark: F.col(mark) + F.make_ym_interval(F.lit(3), F.lit(0)), "T2M_MAX": F.lit("40.0")}
        ).unionByName(late.withColumn("T2M_MAX", F.lit("-40.0")))
    )
    return incremental.read_table(spark, table)


@query(
    "streaming_upsert",
    sql.chain("legacy_daily")
    + f"""SELECT {sql.columns(sql.LEGACY_COLUMNS)} FROM (SELECT *, row_number() OVER (
    PARTITION BY location_id, date ORDER BY {sql.newest(*sql.VERSION)}) AS rn
    FROM legacy_daily) WHERE rn = 1""",
)
def _(spark, d):
    """Raw files read as a stream in several micro-batches, each merged into the table."""
    raw, table = new_path(spark, "raw"), new_path(spark, "daily")
    # Copies of one day come from different orders and lie in different files, so later
    # batches meet rows of earlier ones.
    adapter.raw_weather(spark, d).write.option("compression", "zstd").parquet(raw)
    files = spark.read.format("binaryFile").load(raw).select("path").count()
    stream = streaming.read_raw_stream(spark, raw, files_per_batch=max(1, files // 3))
    job = streaming.run_available(stream, table, new_path(spark, "progress"))
    job.awaitTermination()
    return incremental.read_table(spark, table)


# --- export -----------------------------------------------------------------------------

def _exported(spark, d) -> tuple[str, dict[str, DataFrame], DataFrame]:
    models, out = _models(spark, d), new_path(spark, "export")
    # Two exported relations are made from the fact.
    models.fct_weather = models.keep(models.fct_weather, "fct_weather")
    relations = {
        "marts/mart_province_campaign": models.mart_province_campaign,
        "marts/location_snapshot": models.location_snapshot,
    }
    return out, relations, exporting.export(spark, relations, out)


@query("export_ndjson_rows", sql.select("mart", MART))
def _(spark, d):
    out, relations, _ = _exported(spark, d)
    name = "marts/mart_province_campaign"
    return spark.read.schema(relations[name].schema).json(f"{out}/{name}")


@query(
    "export_manifest",
    sql.chain("mart", "snapshot")
    + """SELECT 'explicit' AS mode, 'marts' AS dataset, 'mart_province_campaign' AS "table",
    'marts.mart_province_campaign' AS qualified_name, 'QUERY' AS relation_type,
    'query' AS export_method, count(*) AS row_count, TRUE AS is_whole FROM mart UNION ALL
SELECT 'explicit', 'marts', 'location_snapshot', 'marts.location_snapshot', 'QUERY', 'query',
    count(*), TRUE FROM snapshot""",
)
def _(spark, d):
    return _exported(spark, d)[2].drop("generated_at", "files", "file_count")


@query(
    "export_discovery",
    sql.chain("tax_rows")
    + """SELECT 'auto' AS mode, name AS "table", kind AS relation_type, method AS export_method, n AS row_count
FROM (SELECT count(*) AS n FROM tax_rows),
    (VALUES ('stored', 'TABLE', 'scan'), ('seen', 'VIEW', 'query')) AS v(name, kind, method)""",
)
def _(spark, d):
    """A database with a stored table and a view, found and exported."""
    database, out = f"export_{uuid.uuid4().hex}", new_path(spark, "export")
    spark.sql(f"CREATE DATABASE {database}")
    tax = _plan(spark, d).tax
    tax.write.option("path", new_path(spark, "stored")).saveAsTable(f"{database}.stored")
    spark.sql(f"CREATE VIEW {database}.seen AS SELECT * FROM {database}.stored")
    manifest = exporting.export(spark, exporting.discover(spark, [database]), out)
    spark.sql(f"DROP DATABASE {database} CASCADE")  # the manifest is files of its own
    return manifest.select("mode", "table", "relation_type", "export_method", "row_count")


@query(
    "export_read_back",
    sql.chain("tax_rows")
    + """SELECT 'tax' AS relation, count(*) - 2 AS found_rows, count(*) AS listed_rows FROM tax_rows""",
)
def _(spark, d):
    """Exported files read back after one of them has lost two lines, and another relation none."""
    out = new_path(spark, "export")
    relations = {"tax": _plan(spark, d).tax.coalesce(1), "locations": _plan(spark, d).current_locations}
    exporting.export(spark, relations, out)
    file = exporting.read_back(spark, out, "tax").first()["file"]
    files.replace_text(spark, f"{out}/tax/{file}", _less(files.read_text(spark, f"{out}/tax/{file}"), 2))
    return exporting.damaged(spark, out).drop("file")


def _less(text: str, lines: int) -> str:
    return "".join(text.splitlines(keepends=True)[:-lines])


def _stored(spark, d) -> str:
    out = new_path(spark, "marts")
    tables.build(_models(spark, d), out)
    return out


@query(
    "stored_fact",
    sql.chain("fact")
    + """SELECT location_id, date, province_key, year(month_start) AS y FROM fact
WHERE month_start >= DATE '1995-01-01' AND month_start < DATE '1996-01-01'""",
)
def _(spark, d):
    """The fact stored by months, and one year read back: other months' folders stay shut."""
    year = F.year("month_start").cast("long")
    months = [date(1995, m, 1) for m in range(1, 13)]
    fact = monthly.read_table(spark, f"{_stored(spark, d)}/fct_weather_daily", months)
    return fact.select("location_id", "date", "province_key", year.alias("y"))


@query("stored_marts", sql.select("mart", MART))
def _(spark, d):
    """All marts stored, the province mart read back."""
    return spark.read.parquet(f"{_stored(spark, d)}/mart_province_campaign").select(*MART)


def _by_location(spark, d) -> tuple[str, Models]:
    database = f"buckets_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database}")
    models = _models(spark, d)
    tasks = spark.sparkContext.defaultParallelism
    buckets = bucketed.enough_buckets(adapter.table(spark, d, "lineitem").count(), tasks)
    models.keep = bucketed.ByLocation(database, new_path(spark, "buckets"), buckets)
    return database, bucketed.build_by_location(models, models.keep)


@query("bucketed_fact", sql.select("fact", QUALITY_TABLE))
def _(spark, d):
    """The fact made from, and kept in, tables bucketed by location."""
    database, models = _by_location(spark, d)
    fact = models.fct_weather
    spark.sql(f"DROP DATABASE {database} CASCADE")  # the tables are files of their own
    return fact


@query("bucketed_snapshot", sql.select("snapshot", SNAPSHOT))
def _(spark, d):
    """The snapshot ranked and joined bucket by bucket."""
    database, models = _by_location(spark, d)
    snapshot = models.location_snapshot
    spark.sql(f"DROP DATABASE {database} CASCADE")
    return snapshot


@query(
    "clustered_province",
    sql.chain("fact")
    + """SELECT location_id, date, province_key, precipitation_mm FROM fact
WHERE province_key = (SELECT min(province_key) FROM fact)""",
)
def _(spark, d):
    """One province of the stored fact: only files whose range of keys covers it are opened."""
    path = f"{_stored(spark, d)}/fct_weather_daily"
    first = monthly.read_table(spark, path).agg(F.min("province_key")).first()[0]
    found = monthly.read_table(spark, path, where={"province_key": first})
    return found.select("location_id", "date", "province_key", "precipitation_mm")


@query("snapshot_view", sql.select("snapshot", ["location_id", "snapshot_date", "climate_index_total"]))
def _(spark, d):
    """The snapshot as a view, read by its name."""
    name = f"snapshot_{uuid.uuid4().hex}"
    tables.as_view(_models(spark, d).location_snapshot, name)
    return spark.sql(f"SELECT location_id, snapshot_date, climate_index_total FROM {name}")


@query("documented_tables", sql.documented({"dim_loc": "dim_location", "legacy_daily": "legacy_daily"}))
def _(spark, d):
    """Comments of stored tables and their columns, as the catalogue tells them, and rows held."""
    database, out = f"documented_{uuid.uuid4().hex}", new_path(spark, "documented")
    spark.sql(f"CREATE DATABASE {database}")
    relations = {
        "dim_location": _models(spark, d, keep=locations_only).dim_location,
        "legacy_daily": legacy.daily(adapter.observations(spark, d)),
    }
    rows = []
    for name, df in relations.items():
        stored = catalogue.save_documented(df, database, name, f"{out}/{name}")
        rows.append((name, stored.count()))
    told = catalogue.comments(spark, database)
    spark.sql(f"DROP DATABASE {database} CASCADE")
    held = spark.createDataFrame(rows, "relation string, row_count bigint")
    return told.where("column_comment IS NOT NULL").join(held, "relation")


@query(
    "backfill_years",
    sql.chain("legacy_daily") + f"SELECT {sql.columns(sql.LEGACY_COLUMNS)} FROM legacy_daily WHERE year(date) >= 1994",
)
def _(spark, d):
    """Slices of years loaded one by one into a table; stopped after two, then gone on with."""
    raw_rows, table = adapter.observations(spark, d), new_path(spark, "daily")
    daily = stage(legacy.daily(raw_rows), "daily")
    slices = windows.year_slices(1994, tail_end=_date_span(daily)[1], reverse=True)

    def load(first: date, last: date) -> None:
        incremental.upsert(windows.date_window(daily, first, last), table, legacy.KEY, streaming.CLUSTER_BY)

    for done, _ in enumerate(windows.resume_backfill(spark, slices, load, f"{table}.slices"), 1):
        if done == 2:
            break
    list(windows.resume_backfill(spark, slices, load, f"{table}.slices"))
    return incremental.read_table(spark, table)


@query(
    "empty_source",
    sql.chain("stg") + "SELECT count(*) AS n, count(location_id) AS located FROM stg",
)
def _(spark, d):
    """A source whose path does not exist yet, next to one that does."""
    missing = raw.read_raw(spark, new_path(spark, "missing"), schemas.RAW_WEATHER)
    both = staging.weather(missing).unionByName(staging.weather(adapter.raw_weather(spark, d)))
    return both.agg(F.count(F.lit(1)).alias("n"), F.count("location_id").alias("located"))


# --- data checks ------------------------------------------------------------------------


@query(
    "check_not_null",
    sql.select("dim_loc", ["location_id", "source_catalog"], where="province_key IS NULL"),
)
def _(spark, d):
    failing = checks.not_null(_plan(spark, d).dim_location, "province_key")
    return failing.select("location_id", "source_catalog")


@query(
    "check_unique",
    sql.chain("stg_loc")
    + """SELECT location_id, count(*) AS row_count FROM stg_loc
GROUP BY location_id HAVING count(*) > 1""",
)
def _(spark, d):
    return checks.unique(_plan(spark, d).stg_locations, "location_id")


@query(
    "check_unique_combo",
    sql.chain("stg")
    + """SELECT location_id, date, count(*) AS row_count FROM stg
GROUP BY location_id, date HAVING count(*) > 1""",
)
def _(spark, d):
    return checks.unique_combination(_plan(spark, d).stg_weather, DAY)


@query(
    "check_accepted_values",
    sql.chain("stg_yields")
    + """SELECT crop_name, count(*) AS row_count FROM stg_yields
WHERE crop_name NOT IN ('soja', 'maíz') GROUP BY crop_name""",
)
def _(spark, d):
    """One crop less than the accepted list, so that rows fail."""
    return checks.accepted_values(
        staging.yields(adapter.yield_csv(spark, d)), "crop_name", ["soja", "maíz"]
    )


@query(
    "check_relationships",
    sql.chain("fact", "dim_prov")
    + """SELECT province_key, count(*) AS row_count FROM fact
WHERE province_key IS NOT NULL AND province_key NOT IN (SELECT province_key FROM dim_prov)
GROUP BY province_key""",
)
def _(spark, d):
    models = _models(spark, d)
    return checks.relationship(
        models.fct_weather, "province_key", models.dim_province, "province_key"
    )


@query(
    "check_expression",
    sql.select(
        "legacy_daily",
        ["location_id", "date", "t2m_max"],
        where="t2m_max IS NOT NULL AND NOT (t2m_max >= -60 AND t2m_max <= 60)",
    ),
)
def _(spark, d):
    value = F.col("t2m_max")
    failing = checks.expression(
        legacy.daily(_flat(spark, d)), value.between(-60, 60), where=value.isNotNull()
    )
    return failing.select(*DAY, "t2m_max")


@query(
    "check_coverage",
    sql.chain("snapshot", "dim_loc")
    + """SELECT """ + sql.cut("ratio") + """ AS coverage_ratio FROM (SELECT
    (SELECT count(*) FROM snapshot) / CAST(count(*) AS DOUBLE) AS ratio FROM dim_loc)
WHERE ratio < 2""",
)
def _(spark, d):
    """Locations with a snapshot over all known ones; twice is asked for, so that it fails."""
    models = _models(spark, d)
    return checks.coverage(models.location_snapshot, models.dim_location, minimum=2)


@query(
    "check_coverage_threshold",
    sql.chain("snapshot", "dim_loc")
    + """SELECT scope, """ + sql.cut("ratio") + """ AS coverage_ratio FROM (
    SELECT 'all' AS scope, (SELECT count(*) FROM snapshot) / CAST(count(*) AS DOUBLE) AS ratio FROM dim_loc
    UNION ALL SELECT 'active', (SELECT count(*) FROM snapshot WHERE is_active) / CAST(count(*) AS DOUBLE)
    FROM dim_loc
    UNION ALL SELECT 'observed', (SELECT count(*) FROM snapshot) / CAST(count(*) AS DOUBLE)
    FROM dim_loc WHERE location_id IN (SELECT location_id FROM snapshot))
WHERE ratio < 0.95""",
)
def _(spark, d):
    """The threshold as it stands, on a snapshot that meets it and on one of active locations."""
    models = _models(spark, d)
    snapshot = stage(models.location_snapshot.select("location_id", "is_active"), "snapshot")
    dim = models.dim_location
    seen = dim.join(snapshot, "location_id", "left_semi")
    scopes = {"all": (snapshot, dim), "active": (snapshot.where("is_active"), dim), "observed": (snapshot, seen)}
    parts = [checks.coverage(s, of).select(F.lit(n).alias("scope"), "coverage_ratio") for n, (s, of) in scopes.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


#: The suite's relations and where their SQL counterparts are.
SUITE_RELATIONS = {
    "stg_locations": "stg_loc",
    "stg_weather": "stg",
    "stg_tax": "tax",
    "stg_yields": "stg_yields",
    "current_locations": "current",
    "weather_base": "base",
    "yields": "yields",
    "tax": "tax",
    "dim_location": "dim_loc",
    "dim_province": "dim_prov",
    "fct_weather": "fact",
    "fct_tax": "fct_tax",
    "fct_yield": "fct_yield",
    "mart_province_campaign": "mart",
    "location_snapshot": "snapshot",
    "legacy_daily": "legacy_daily",
}


@query("check_suite", sql.suite(suite.SUITE, SUITE_RELATIONS))
def _(spark, d):
    """Every declared check over the whole model graph, one pass over each relation."""
    # What one step shuffles is deleted before the next: days of the first generation, which no
    # other relation has to do with, days to store, the fact, and the rest.
    alone = suite.run_suite({"legacy_daily": legacy.daily(_flat(spark, d))})
    alone = stage(alone, "checked")
    release(spark)
    models = _models(spark, d)
    _ = models.best_weather
    release(spark)
    models.fct_weather = models.keep(models.fct_weather, "fct_weather")
    release(spark)
    others = {
        "stg_tax": lambda: staging.tax(adapter.tax_csv(spark, d)),
        "stg_yields": lambda: staging.yields(adapter.yield_csv(spark, d)),
    }
    names = [n for n in SUITE_RELATIONS if n != "legacy_daily"]
    relations = {n: others[n]() if n in others else getattr(models, n) for n in names}
    release(spark)
    return suite.run_suite(relations).unionByName(alone)


@query(
    "check_prefers_usable",
    sql.chain("partial")
    + """, usable AS (SELECT DISTINCT location_id FROM partial
    WHERE is_quality_approved AND NOT is_partial_latest_day),
newest AS (SELECT *, row_number() OVER (PARTITION BY location_id ORDER BY date DESC) AS rn FROM partial)
SELECT location_id, 'fallback' AS selection_strategy, date AS snapshot_date FROM newest
WHERE rn = 1 AND NOT (is_quality_approved AND NOT is_partial_latest_day)
    AND location_id IN (SELECT location_id FROM usable)""",
)
def _(spark, d):
    """The check on a snapshot that simply takes the newest day, which it must reject."""
    fact = _models(spark, d).weather_quality
    naive = best_row(fact, ["location_id"], newest("date"), [])
    usable = F.col("is_quality_approved") & ~F.col("is_partial_latest_day")
    strategy = F.when(usable, F.lit("usable")).otherwise(F.lit("fallback"))
    snapshot = naive.select(
        "location_id", strategy.alias("selection_strategy"), F.col("date").alias("snapshot_date")
    )
    return checks.prefers_usable(snapshot, fact)
