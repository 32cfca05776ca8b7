"""Declared data checks over the whole model graph, run in one pass over each relation."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CROPS = ["soja", "maíz", "trigo"]


@dataclass(frozen=True)
class Row:
    """Check that looks at one row at a time: holds where `where` applies."""

    label: str
    holds: str
    where: str = "true"


@dataclass(frozen=True)
class Unique:
    columns: tuple[str, ...]


@dataclass(frozen=True)
class Parent:
    column: str
    parent: str


def present(*columns: str) -> list[Row]:
    return [Row(f"not_null {c}", f"{c} is not null") for c in columns]


def within(column: str, low: float, high: float, nullable: bool = True) -> Row:
    where = f"{column} is not null" if nullable else "true"
    return Row(f"range {column}", f"{column} between {low} and {high}", where)


def not_negative(column: str) -> Row:
    return Row(f"not_negative {column}", f"{column} >= 0", f"{column} is not null")


def one_of(column: str, values: list[str]) -> Row:
    listed = ", ".join(f"'{v}'" for v in values)
    return Row(f"accepted {column}", f"{column} in ({listed})", f"{column} is not null")


CAMPAIGN_GRAIN = Unique(("province_key", "campaign_name", "crop_key"))
DAY_GRAIN = Unique(("location_id", "date"))

SUITE: dict[str, list[Row | Unique | Parent]] = {
    "tax_csv": [*present("province_name"), Unique(("province_name",))],
    "yield_csv": present("crop_name", "campaign_name", "province_name", "department_name"),
    "stg_locations": present("location_id"),
    "stg_weather": present("location_id", "date"),
    "stg_tax": [*present("province_name"), Unique(("province_key",))],
    "stg_yields": [
        one_of("crop_name", CROPS),
        *present("campaign_name", "province_name", "department_name"),
    ],
    "current_locations": [*present("location_id"), Unique(("location_id",))],
    "weather_base": [DAY_GRAIN],
    "yields": [CAMPAIGN_GRAIN],
    "tax": [Unique(("province_key",))],
    "dim_location": [*present("location_id", "province_key"), Unique(("location_id",))],
    "dim_province": [*present("province_key", "province_name"), Unique(("province_key",))],
    "fct_weather": [
        *present("location_id", "province_key", "date"),
        DAY_GRAIN,
        Parent("location_id", "dim_location"),
        Parent("province_key", "dim_province"),
        not_negative("precipitation_mm"),
        within("relative_humidity_pct", 0, 100),
    ],
    "fct_tax": [
        *present("province_key"),
        Unique(("province_key",)),
        Parent("province_key", "dim_province"),
    ],
    "fct_yield": [
        *present("province_key", "crop_name"),
        CAMPAIGN_GRAIN,
        Parent("province_key", "dim_province"),
        not_negative("yield_kg_ha"),
    ],
    "mart_province_campaign": [
        *present("province_key", "campaign_name", "crop_name"),
        CAMPAIGN_GRAIN,
    ],
    "location_snapshot": [
        *present("location_id", "snapshot_date", "province_key"),
        Unique(("location_id",)),
        Parent("location_id", "dim_location"),
        one_of("selection_strategy", ["usable", "fallback"]),
        within("climate_rain_signal", 0, 100),
        within("climate_water_stress_signal", 0, 100),
        within("climate_temperature_signal", 0, 100),
        within("climate_index_total", 0, 1),
    ],
    "legacy_daily": [
        *present("location_id", "date"),
        DAY_GRAIN,
        within("latitude", -90, 90, nullable=False),
        within("longitude", -180, 180, nullable=False),
        within("t2m_max", -60, 60),
        within("t2m_min", -60, 60),
        within("precipitation_corrected", 0, 400),
        within("relative_humidity_2m", 0, 100),
        within("wind_speed_2m", 0, 50),
        within("wind_direction_2m", 0, 360),
    ],
}


def label(check: Row | Unique | Parent) -> str:
    if isinstance(check, Row):
        return check.label
    if isinstance(check, Unique):
        return f"unique {', '.join(check.columns)}"
    return f"known {check.column}"


def _entry(test: int, key: Column, child: Column | int, parent: int = 0) -> Column:
    """What one row of a relation adds to one check."""
    return F.struct(
        F.lit(test).alias("test"),
        key.alias("key"),
        (child if isinstance(child, Column) else F.lit(child)).cast("long").alias("child"),
        F.lit(parent).cast("long").alias("parent"),
    )


def _key(columns: list[str]) -> Column:
    """The values of some columns, of whatever types, as one text that tells them apart."""
    numbered = [F.col(c).alias(str(i)) for i, c in enumerate(columns)]
    return F.to_json(F.struct(*numbered), {"ignoreNullFields": "false"})


def _expanded(
    df: DataFrame,
    rows: list[tuple[int, Row]],
    uniques: list[tuple[int, Unique]],
    children: list[tuple[int, Parent]],
    known: list[tuple[int, Parent]],
) -> DataFrame:
    """Every row of a relation as its parts in the checks, its own and those it is parent to.

    An entry has no more than its check, its key and two counts, and rows that pass a row check
    make none: most entries are one row's alone, and are shuffled as they are."""
    entries = []
    nothing = F.lit(None).cast("string")
    for test, check in rows:
        # An unknown condition passes.
        failed = F.expr(check.where) & F.coalesce(~F.expr(check.holds), F.lit(False))
        entries.append(_entry(test, nothing, F.coalesce(failed, F.lit(False))))
    for test, check in uniques:
        # A lone NULL is no value; a combination may hold some.
        counted = F.col(check.columns[0]).isNotNull() if len(check.columns) == 1 else 1
        entries.append(_entry(test, _key(list(check.columns)), counted))
    for test, check in children:
        entries.append(_entry(test, _key([check.column]), F.col(check.column).isNotNull()))
    for test, check in known:
        entries.append(_entry(test, _key([check.column]), 0, parent=1))
    return df.select(F.inline(F.array(*entries))).where("child > 0 or parent > 0")


def run_suite(
    relations: dict[str, DataFrame], suite: dict[str, list[Row | Unique | Parent]] = SUITE
) -> DataFrame:
    """Relation, check and number of failures: rows, or keys for the checks on keys.

    Relations that are not given are skipped. Every relation is read once: a row becomes one entry
    for each row check it fails and one for each key it holds or vouches for, entries are added up
    by check and key, partially before they are shuffled, and the sums once more by check. Neither
    a frequent key nor a long relation comes together in a task.
    """
    given = {n: declared for n, declared in suite.items() if n in relations}
    tests = [(n, c) for n, declared in given.items() for c in declared]
    number = {test: i for i, test in enumerate(tests)}
    parts = []
    for name in given:
        declared = dict.fromkeys(given[name])
        rows = [(number[name, c], c) for c in declared if isinstance(c, Row)]
        uniques = [(number[name, c], c) for c in declared if isinstance(c, Unique)]
        children = [(number[name, c], c) for c in declared if isinstance(c, Parent)]
        known = [
            (number[n, c], c) for n, c in tests if isinstance(c, Parent) and c.parent == name
        ]
        parts.append(_expanded(relations[name], rows, uniques, children, known))
    missing = {
        c.parent for _, c in tests if isinstance(c, Parent) and c.parent not in given
    }
    if missing:
        raise ValueError(f"parents of checked relations are not given: {sorted(missing)}")
    sums = [F.sum(c).alias(c) for c in ["child", "parent"]]
    by_key = reduce(DataFrame.unionByName, parts).groupBy("test", "key").agg(*sums)
    by_test = by_key.groupBy("test").agg(
        F.count_if(F.expr("child > 1")).alias("repeated"),
        F.count_if(F.expr("child > 0 and parent = 0")).alias("unknown"),
        F.sum("child").alias("failed"),
    )
    # One row a declared check, whatever the relations hold.
    kinds = {Row: "failed", Unique: "repeated", Parent: "unknown"}
    listed = [(n, label(c), number[n, c], kinds[type(c)]) for n, c in tests]
    spark = by_test.sparkSession
    declared = spark.createDataFrame(listed, "relation string, check string, test int, measure string")
    value = F.coalesce(*[F.when(F.col("measure") == m, F.col(m)) for m in kinds.values()], F.lit(0))
    return declared.join(by_test, "test", "left").select("relation", "check", value.alias("failures"))
