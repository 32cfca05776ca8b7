"""Weather-shaped sources derived from the star-schema tables used for verification.

There is no weather table among them, so suppliers play locations, line items play daily
observations, customers carry tax rates and ordered parts become crop yields. Every value
follows from the row by exact arithmetic, and every kind of irregularity the models handle
(missing, contradictory or dirty values, deletions, repeated loads) occurs. All of it is
projection, joins and aggregation over the given tables, so it grows with them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pampero.functions.calendar import campaign_name, campaign_start_year
from pampero.sources.raw import catalog_as_raw, read_csv
from pampero.sources.schemas import (
    CATALOG_CSV,
    LOCATION_PAYLOAD,
    REPLICATION,
    TAX_CSV,
    WEATHER_PAYLOAD,
    WEATHER_VARIABLES,
    YIELD_CSV,
)
from pampero.workspace import new_path

TABLES = ["lineitem", "supplier", "nation", "region", "customer", "orders", "part"]
TEXT_TIME = "yyyy-MM-dd HH:mm:ss"
CROPS = {
    "ECONOMY": "soja",
    "MEDIUM": "maíz",
    "SMALL": "trigo",
    "STANDARD": "soja",
    "LARGE": "maíz",
    "PROMO": "trigo",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _every(key: Column, n: int) -> Column:
    return F.pmod(key, F.lit(n)) == 0


def _number(value: Column) -> Column:
    return value.cast("double")


def _province(name: Column, nation: Column, second: Column) -> Column:
    """Nation name as a province: plain, accented, or in lower case."""
    return (
        F.when(F.pmod(nation, F.lit(3)) == 0, name)
        .when(F.pmod(nation, F.lit(3)) == 1, second)
        .otherwise(F.lower(name))
    )


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as flat raw weather: typed replication columns and text measures."""
    used = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity"]
    lines = table(spark, sf_dir, "lineitem").select(*used, "l_extendedprice", "l_shipdate")
    o, p, s, n = (F.col(c) for c in ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"])
    shipped = F.col("l_shipdate").cast("timestamp")

    temp = F.col("l_quantity") - 8.0 + F.when(_every(o, 997), 60.0).otherwise(0.0)
    humidity = _number(15 + F.pmod(p, F.lit(85)))
    rain = F.when(n <= 3, F.lit(0.0)).otherwise(_number(F.floor(F.col("l_extendedprice") / 2000)))
    wind = _number(F.pmod(o, F.lit(40))) / 4.0 + F.when(_every(o, 499), 55.0).otherwise(0.0)
    clear = _number(10 + F.pmod(p, F.lit(20)))
    measures = {
        "T2M_MAX": F.when(_every(o, 211), temp - 9.0).otherwise(temp + 2.0 + _number(n)),
        "T2M_MIN": temp - 2.0 - _number(F.pmod(p, F.lit(7))),
        "T2M": temp,
        "T2MDEW": temp - (100.0 - humidity) / 5.0,
        "PRECTOTCORR": rain + F.when(_every(o, 503), 450.0).otherwise(0.0),
        "RH2M": humidity,
        "ALLSKY_SFC_SW_DWN": F.when(_every(o, 307), clear + 1.0).otherwise(clear * 0.75),
        "CLRSKY_SFC_SW_DWN": clear,
        "WS2M": wind,
        "T2MWET": temp,
        "TS": temp,
        "QV2M": humidity / 5000.0,
        "WS2M_MAX": wind + 1.0 + _number(F.pmod(p, F.lit(5))),
        "WD2M": _number(F.pmod(o * 7, F.lit(360))),
        "PS": _number(90 + F.pmod(p, F.lit(12))),
        "CLOUD_AMT": _number(F.pmod(p * 3, F.lit(101))),
    }
    gaps = {}
    for k, (name, value) in enumerate(measures.items()):
        missing = _every(31 * o + 7 * n + p + 5 * k, 29)
        if k >= 5:
            missing = missing | _every(o, 97)
        gaps[name] = F.when(~missing, value).cast("string")
    gaps["CLOUD_AMT"] = F.when(_every(o, 89), F.lit("n/a")).otherwise(gaps["CLOUD_AMT"])

    extracted = shipped + F.make_interval(hours=F.pmod(p, F.lit(24)).cast("int"))
    loaded = F.date_format(shipped + F.make_interval(hours=n), TEXT_TIME)
    date = F.when(_every(o, 211), F.date_format(shipped, "yyyy-M-d")).otherwise(
        F.date_format(shipped, "yyyy-MM-dd")
    )
    described = {
        "location_id": F.when(~_every(o, 1013), F.concat(F.lit("loc_"), s.cast("string"))),
        "location_name": F.concat(F.lit("Punto "), s.cast("string")),
        "province_name": F.when(
            F.pmod(s, F.lit(4)) != 3,
            F.concat(F.lit("NATION_"), F.pmod(s, F.lit(25)).cast("string")),
        ),
        "latitude": (-20.0 - _number(F.pmod(s, F.lit(350))) / 10.0).cast("string"),
        "longitude": (-55.0 - _number(F.pmod(s, F.lit(180))) / 10.0).cast("string"),
        "date": F.when(_every(o, 1009), F.lit("sin fecha")).otherwise(date),
        "x_source": F.lit("NASA POWER"),
        "x_source_type": F.when(~_every(o, 17), F.lit("satellite")),
        "x_loaded_at": F.when(~_every(o, 13), loaded),
    }
    stamps = {
        "_sdc_extracted_at": extracted,
        "_sdc_received_at": extracted + F.make_interval(mins=F.lit(1)),
        "_sdc_batched_at": extracted + F.make_interval(mins=F.lit(2)),
        "_sdc_deleted_at": F.when(_every(o, 101), extracted),
        "_sdc_sequence": 10 * o + n,
        "_sdc_table_version": F.lit(1).cast("bigint"),
    }
    payload = {**described, **{v: gaps[v] for v, _, _, _ in WEATHER_VARIABLES}}
    return lines.select(
        *[c.alias(name) for name, c in stamps.items()],
        *[payload[name].alias(name) for name in WEATHER_PAYLOAD.fieldNames()],
    )


def raw_weather(spark: SparkSession, sf_dir: str, form: str = "struct") -> DataFrame:
    """Observations with a struct payload, a JSON or VARIANT payload, or flat without one."""
    if form == "flat":
        return observations(spark, sf_dir)
    data = F.struct(*WEATHER_PAYLOAD.fieldNames())
    if form in ("json", "variant"):
        data = F.to_json(data)
    if form == "variant":
        data = F.parse_json(data)
    return observations(spark, sf_dir).select(*REPLICATION, data.alias("data"))


def _located(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers with nation and region."""
    suppliers = table(spark, sf_dir, "supplier")
    nations = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return suppliers.join(nations, F.col("s_nationkey") == F.col("n_nationkey"))


def _position(s: Column, start: float, span: int) -> Column:
    return (start - _number(F.pmod(s, F.lit(span))) / 10.0).cast("string")


def _location_province() -> Column:
    accented = F.concat(F.lit("  Río  "), F.col("n_name"), F.lit("\t"))
    return _province(F.col("n_name"), F.col("n_nationkey"), accented)


def raw_locations(spark: SparkSession, sf_dir: str, form: str = "struct") -> DataFrame:
    """Two snapshots of each catalogued supplier, some of them deletions."""
    s = F.col("s_suppkey")
    versions = _located(spark, sf_dir).withColumn(
        "version", F.explode(F.array(F.lit(1), F.lit(2)))
    )
    version = F.col("version")
    start = F.lit("2001-01-01 00:00:00").cast("timestamp")
    extracted = start + F.make_interval(
        days=version * 30, hours=F.pmod(s, F.lit(24)).cast("int")
    )
    deleted = _every(s, 10) | _every(s, 21) | (_every(s, 7) & (version == 2))
    payload = {
        "location_id": F.concat(F.lit("loc_"), s.cast("string")),
        "location_name": F.concat_ws(" ", F.lit("Estación"), s.cast("string"), version.cast("string")),
        "province_name": _location_province(),
        "department_name": F.col("r_name"),
        "municipality_name": F.when(
            ~_every(s, 5), F.concat(F.lit("Municipio "), F.pmod(s, F.lit(17)).cast("string"))
        ),
        "latitude": _position(s, -21.0, 340),
        "longitude": _position(s, -54.0, 170),
        "elevation": F.when(_every(s, 11), F.lit("s/d")).otherwise(
            F.pmod(s, F.lit(2500)).cast("string")
        ),
        "country_code": F.when(~_every(s, 9), F.lit("AR")),
        "is_active": F.when(_every(s, 23), F.lit("yes"))
        .when(_every(s, 4), F.lit("FALSE"))
        .otherwise(F.lit("true")),
        "source_catalog": F.lit("supplier"),
        "x_source_type": F.lit("catalog"),
        "x_loaded_at": F.when(~_every(s, 13), F.date_format(extracted, TEXT_TIME)),
    }
    data = F.struct(*[payload[n].alias(n) for n in LOCATION_PAYLOAD.fieldNames()])
    if form == "json":
        data = F.to_json(data)
    return versions.select(
        extracted.alias("_sdc_extracted_at"),
        (extracted + F.make_interval(mins=F.lit(1))).alias("_sdc_received_at"),
        (extracted + F.make_interval(mins=F.lit(2))).alias("_sdc_batched_at"),
        F.when(deleted, extracted).alias("_sdc_deleted_at"),
        (10 * s + version).alias("_sdc_sequence"),
        F.lit(1).cast("bigint").alias("_sdc_table_version"),
        data.alias("data"),
    )


def through_csv(df: DataFrame, name: str, schema) -> DataFrame:
    """Write rows as CSV to the shared folder and read them back as a reference file."""
    path = new_path(df.sparkSession, f"{name}.csv")
    df.write.csv(path, header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return read_csv(df.sparkSession, path, schema)


def catalog_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogued suppliers as the seven-column location catalogue file."""
    s = F.col("s_suppkey")
    rows = _located(spark, sf_dir).select(
        F.concat(F.lit("cat_"), s.cast("string")).alias("location_id"),
        F.concat(F.lit("Estación "), s.cast("string")).alias("location_name"),
        F.trim(F.col("n_name")).alias("province_name"),
        _position(s, -21.0, 340).alias("latitude"),
        _position(s, -54.0, 170).alias("longitude"),
        F.lit("AR").alias("country_code"),
        F.when(_every(s, 4), F.lit("false")).otherwise(F.lit("true")).alias("is_active"),
    )
    return through_csv(rows, "locations", CATALOG_CSV)


def catalog_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog_as_raw(catalog_csv(spark, sf_dir), "2002-01-01 00:00:00")


def tax_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Account balances per nation as land tax; one province name is blank."""
    customers = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(
        F.min("c_acctbal").alias("low"),
        F.max("c_acctbal").alias("high"),
        F.round(F.avg("c_acctbal"), 4).alias("mean"),
    )
    nations = customers.join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    nation = F.col("n_nationkey")
    accented = F.concat(F.lit("RÍO "), F.col("n_name"))
    name = F.when(nation == 24, F.lit("   ")).otherwise(
        F.upper(_province(F.col("n_name"), nation, accented))
    )
    rows = nations.select(
        name.alias("province_name"),
        F.col("low").alias("rural_property_tax_usd_ha_min"),
        F.col("high").alias("rural_property_tax_usd_ha_max"),
        F.col("mean").alias("rural_property_tax_usd_ha_avg"),
        (_number(F.pmod(nation, F.lit(5))) * 0.25).alias("gross_turnover_tax_pct"),
    )
    return through_csv(rows, "tax", TAX_CSV)


def yield_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordered parts as harvests per nation, market segment and campaign.

    Lines are summed per order and crop before they meet the orders, so an order or part with
    very many lines arrives there as a few rows.
    """
    parts = table(spark, sf_dir, "part")
    crop = F.lit(None).cast("string")
    for kind, name in CROPS.items():
        crop = F.when(F.col("p_type") == kind, F.lit(name)).otherwise(crop)
    lines = table(spark, sf_dir, "lineitem").join(
        parts.select("p_partkey", crop.alias("crop")), F.col("l_partkey") == F.col("p_partkey")
    )
    harvested = F.when(F.col("l_linestatus") == "F", F.col("l_quantity")).otherwise(0.0)
    # Prices have two decimals: summed as whole cents the totals do not depend on the order.
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    by_order = lines.groupBy("l_orderkey", "crop").agg(
        F.sum("l_quantity").alias("sown"),
        F.sum(harvested).alias("harvested"),
        F.sum(cents).alias("cents"),
    )
    orders = (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    )
    began = campaign_start_year(F.col("o_orderdate"))
    accented = F.concat(F.lit("Río "), F.col("n_name"))
    grouped = (
        by_order.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy(
            "crop",
            began.alias("began"),
            _province(F.col("n_name"), F.col("n_nationkey"), accented).alias("province_name"),
            F.col("n_nationkey").alias("province_id"),
            F.col("c_mktsegment").alias("department_name"),
        )
        .agg(
            F.sum("sown").alias("sown"),
            F.sum("harvested").alias("harvested"),
            F.sum("cents").alias("cents"),
        )
    )
    tonnes = _number(F.col("cents")) / 100000.0
    rows = grouped.select(
        F.concat(F.lit(" "), F.initcap("crop")).alias("crop_name"),
        (F.col("began") + 1).alias("harvest_year"),
        campaign_name(F.col("began")).alias("campaign_name"),
        "province_name",
        "province_id",
        "department_name",
        F.substring("department_name", 1, 4).alias("department_id"),
        F.col("sown").alias("sown_area_ha"),
        F.col("harvested").alias("harvested_area_ha"),
        tonnes.alias("production_tonnes"),
        F.when(F.col("harvested") > 0, tonnes * 1000.0 / F.col("harvested")).alias("yield_kg_ha"),
    )
    return through_csv(rows, "yields", YIELD_CSV)
