"""Relations kept in the catalogue, bucketed and sorted by location.

Joins of locations, days and facts, and rankings by location, then read buckets side by side and
shuffle nothing. Deduplication leaves at most one row of a location and day, so no bucket is hot.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pampero.plans import weather
from pampero.plans.models import Models
from pampero.sources.schemas import documented
from pampero.workspace import release, stage

KEY = "location_id"

#: Raw snapshots of a location from which on its days are ranked before its rows come together.
HOT_ROWS = 500_000


@dataclass(frozen=True)
class ByLocation:
    """How `Models` keep relations: those with a location as tables of ``database``, bucketed;
    others as `stage` does.

    All tables have the same number of buckets, chosen for the largest; a bucket is one file,
    sorted, so its size is the table's over their number. A relation that already comes by
    bucket is written without a shuffle.
    """

    database: str
    out: str
    buckets: int

    def __call__(self, df: DataFrame, name: str) -> DataFrame:
        if KEY not in df.columns:
            return stage(df, name)
        return self.save(df, name)

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """The relation, stored. The shuffles it took are deleted."""
        spark = df.sparkSession
        table = f"{self.database}.{name}"
        (
            documented(self.dealt(df))
            .write.bucketBy(self.buckets, KEY)
            .sortBy(KEY)
            .mode("overwrite")
            .option("path", f"{self.out}/{name}")
            .saveAsTable(table)
        )
        release(spark)
        return spark.table(table)

    def best_days(self, staged: DataFrame) -> DataFrame:
        """`best_daily_rows` by bucket: raw rows are shuffled once, to where they are ranked and
        written. A location of very many snapshots is brought down to one row a day before."""
        live = weather.live_rows(staged)
        counted = live.groupBy(KEY).agg(F.count(F.lit(1)).alias("n"))
        # One value per HOT_ROWS rows of the table at most.
        hot = [r[0] for r in counted.where(F.col("n") > HOT_ROWS).select(KEY).collect()]
        if hot:
            is_hot = F.col(KEY).isin(hot)
            ranked = weather.best_daily_rows(live.where(is_hot)).select(*live.columns)
            live = live.where(~is_hot).unionByName(ranked)
        return weather.best_daily_rows(live.repartition(self.buckets, F.col(KEY)))

    def dealt(self, df: DataFrame) -> DataFrame:
        """Rows by bucket, one task each. What already lies so is left alone."""
        partitioning = df._jdf.queryExecution().sparkPlan().outputPartitioning().toString()
        at = f"hashpartitioning({KEY}#"
        if partitioning.startswith(at) and partitioning.endswith(f", {self.buckets})"):
            return df
        return df.repartition(self.buckets, F.col(KEY))


def enough_buckets(rows: int, tasks: int, bucket_rows: int = 4_000_000) -> int:
    """A power of two, so that tables of different size can still be met bucket by bucket: a task
    each at least, and no bucket much above ``bucket_rows``."""
    return 1 << (max(tasks, -(-rows // bucket_rows), 1) - 1).bit_length()


def build_by_location(models: Models, keep: ByLocation) -> Models:
    """Store fact and dimension of a graph whose relations ``keep`` keeps, and read them back.

    What comes after, the location snapshot among it, is made from the stored tables.
    """
    models.fct_weather = keep.save(models.fct_weather, "fct_weather_daily")
    return models
