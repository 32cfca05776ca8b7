"""Spark session settings this package relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Correctness: text timestamps without a zone are UTC.
TIME_ZONE = {"spark.sql.session.timeZone": "UTC"}

# Speed: the JVM compiles no method beyond 8000 bytes of bytecode. A stage of many casts and
# formulas exceeds that when generated as one method and would run interpreted, several times
# slower; under this limit Spark generates it as smaller methods instead.
CODE_SIZE = {"spark.sql.codegen.hugeMethodLimit": "8000"}

# Speed: Spark records the Python line of every column operation unless told not to, which
# takes longer than building the plans of this package, of hundreds of expressions each.
CALL_SITES = {"spark.python.sql.dataFrameDebugging.enabled": "false"}

# Scale: the default INT96 timestamps carry no statistics, so a high-water-mark filter could not
# skip row groups; microsecond timestamps can, and decode faster.
STORAGE = {"spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS"}

# Scale: let Spark re-plan at run time, split skewed join partitions, size broadcasts by
# measured bytes. Shuffle partitions are a ceiling that AQE coalesces.
SCALE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


# Scale: rows derived from a split are some forty times wider in memory than its columns are in
# Parquet. The best row of each key is taken by a sort within every task before the shuffle, and
# stays in memory, whatever the table's size, if a split is no larger than this. A session that
# asks for smaller ones keeps them.
SPLIT_BYTES = 8 << 20
SPLITS = {"spark.sql.files.maxPartitionBytes": str(SPLIT_BYTES)}

CHANGEABLE = {**TIME_ZONE, **CODE_SIZE, **STORAGE}


def build_session(app: str = "pampero", master: str | None = None, **conf: str) -> SparkSession:
    """New or current session; on a cluster leave `master` to spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**CHANGEABLE, **CALL_SITES, **SCALE, **SPLITS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Give a session someone else built the settings that can still be changed."""
    for key, value in CHANGEABLE.items():
        spark.conf.set(key, value)
    if spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes() > SPLIT_BYTES:
        for key, value in SPLITS.items():
            spark.conf.set(key, value)
    return spark
