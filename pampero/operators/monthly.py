"""Month-partitioned tables whose months change all at once, in files of narrow ranges.

Every load writes the months it changes into a folder of its own, and one small file, the
pointer, then names the folder of each month::

    <table>/load=<n>-<token>/month_start=<month>/span=<k>/part-*.parquet
    <table>/spans/load=<n>-<token>          the range of keys in each file of the load
    <table>/current.json                    the pointer: months, schema, high-water mark

Replacing the pointer is the only step that readers see. A load that is killed before it, the
first included, leaves months, schema and mark as they were; its folder is deleted once another
has taken its number. Folders that a load supersedes stay until the load after, for readers under way. One load
at a time writes a table; a second one that commits in between is noticed, and an error.

Within a load, rows are ordered by month and cluster columns and cut at quantiles, so that a
file holds a short range of the first cluster column, and a value of it that holds much of
the table is cut by the next one. Quantiles come from the key columns of stored relations alone;
the rows themselves are worked out once.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, field, replace
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pampero.files import read_text, replace_text, subfolders
from pampero.workspace import discard, release

MONTH = "month_start"

#: Rows of a file: as many as this where there are enough, which a task sorts in memory, and no
#: fewer than that for the sake of more tasks.
FILE_ROWS, LEAST_ROWS = 500_000, 2_000

#: Rows of stored relations that are written in one go: more are written in passes over months, so
#: that the shuffle of one is deleted before the next, but in no more passes than these, since
#: each reads the rows again.
PASS_ROWS, PASSES = 4_000_000, 8

#: How a month is written in folder names and the pointer.
NO_MONTH = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class State:
    """What the pointer says. ``months`` name the folder of each month, within the table; ``""`` is
    the table itself, where months were written by other means."""

    load: int = 0
    months: dict[str, str] = field(default_factory=dict)
    replaced: list[str] = field(default_factory=list)
    schema: dict | None = None
    cluster_by: list[str] = field(default_factory=list)
    mark: str | None = None


def pointer(path: str) -> str:
    return f"{path.rstrip('/')}/current.json"


def read_state(spark: SparkSession, path: str) -> State:
    """The committed state; that of a plain folder of months if there is no pointer."""
    text = read_text(spark, pointer(path))
    if text is not None:
        return State(**json.loads(text))
    found = [n.partition("=")[2] for n in subfolders(spark, path) if n.startswith(f"{MONTH}=")]
    return State(months=dict.fromkeys(found, ""))


def commit(spark: SparkSession, path: str, before: State, after: State) -> None:
    """Make a state the table's, unless another load has done so since ``before`` was read."""
    if read_state(spark, path).load != before.load:
        raise RuntimeError(f"another load has changed {path}")
    replace_text(spark, pointer(path), json.dumps(asdict(after)))


def sweep(spark: SparkSession, path: str, state: State) -> None:
    """Delete what no reader can see: months of killed loads, and those the last load but one
    superseded."""
    if state.schema is None:
        return  # No pointer yet: months lie in the table itself.
    alive = {f"{folder}/{MONTH}={month}" for month, folder in state.months.items()}
    alive |= set(state.replaced)
    loads = {*subfolders(spark, path), *subfolders(spark, f"{path}/spans")}
    for load in sorted(n for n in loads if n.startswith("load=")):
        if int(load.removeprefix("load=").partition("-")[0]) > state.load:
            continue  # Under way, or dead; the load after the next commit can tell.
        months = [f"{load}/{m}" for m in subfolders(spark, f"{path}/{load}")]
        gone = [m for m in months if m not in alive]
        if len(gone) == len(months):
            discard(spark, f"{path}/{load}")
            discard(spark, f"{path}/spans/{load}")
        else:
            for month in gone:
                discard(spark, f"{path}/{month}")


def written(month: date | None) -> str:
    """A month as folders and the pointer name it."""
    return NO_MONTH if month is None else month.isoformat()


def read_table(
    spark: SparkSession,
    path: str,
    months: list[date | None] | None = None,
    where: dict[str, object] | None = None,
) -> DataFrame | None:
    """The table as last committed; None before its first load.

    ``months`` opens only the folders of these. ``where`` gives values of the first cluster
    columns: only rows that hold them are returned, and only files whose range covers them are
    opened. The names of these, as many as files read, come to the driver, as file names do.
    """
    state = read_state(spark, path)
    if not state.months:
        return None
    named = state.months
    if months is not None:
        wanted = {written(m) for m in months}
        named = {m: f for m, f in named.items() if m in wanted}
    filters = [F.col(c).eqNullSafe(F.lit(v)) for c, v in (where or {}).items()]
    if state.schema is None:
        df = spark.read.parquet(path)
        chosen = F.coalesce(F.col(MONTH).cast("string"), F.lit(NO_MONTH)).isin(list(named))
        return _where(df if months is None else df.where(chosen), filters)
    schema = T.StructType.fromJson(state.schema)
    loaded = {m: f for m, f in named.items() if f}
    folders = [f"{path}/{f}/{MONTH}={m}" for m, f in loaded.items()]
    if where and list(where) == state.cluster_by[: len(where)]:
        folders = _covering(spark, path, loaded, where)
    parts = []
    if folders:
        parts.append(_open(spark, path, schema, folders))
    adopted = [f"{path}/{MONTH}={m}" for m, f in named.items() if not f]
    if adopted:
        parts.append(_open(spark, path, schema, adopted))
    if not parts:
        return spark.createDataFrame([], schema)
    df = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return _where(df, filters)


def _open(spark: SparkSession, path: str, schema: T.StructType, folders: list[str]) -> DataFrame:
    opened = spark.read.schema(schema).option("basePath", path).parquet(*folders)
    return opened.select(*schema.names)


def _where(df: DataFrame, filters: list[Column]) -> DataFrame:
    for condition in filters:
        df = df.where(condition)
    return df


def _covering(
    spark: SparkSession, path: str, months: dict[str, str], where: dict[str, object]
) -> list[str]:
    """Folders of the files whose ranges cover the given values of the first cluster columns."""
    if not months:
        return []
    loads = sorted(set(months.values()))
    spans = spark.read.option("basePath", f"{path}/spans").parquet(*[f"{path}/spans/{f}" for f in loads])
    month = F.coalesce(F.col(MONTH).cast("string"), F.lit(NO_MONTH))

    def key(end: str) -> Column:
        return F.struct(*[F.col(f"{end}.{c}") for c in where])

    value = F.struct(*[F.lit(v).alias(c) for c, v in where.items()])
    within = (key("low") <= value) & (value <= key("high"))
    found = spans.where(within).select(F.col("load").cast("string"), month, "span")
    return [
        f"{path}/load={load}/{MONTH}={m}/span={k}"
        for load, m, k in found.collect()
        if months.get(m) == f"load={load}"
    ]


def spans_of(keys: DataFrame, cluster_by: list[str], count: int) -> DataFrame:
    """``month_start, span, low, high``: the range of cluster columns of each file to be written."""
    key = F.struct(*cluster_by)
    ranged = keys.repartitionByRange(count, MONTH, *cluster_by)
    return (
        ranged.withColumn("span", F.spark_partition_id())
        .groupBy(MONTH, "span")
        .agg(F.min(key).alias("low"), F.max(key).alias("high"))
    )


def span_of(cuts: Column, key: Column, most: int) -> Column:
    """The span of a key, by a binary search of its month's spans in order of their low ends."""
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(max(most, 1).bit_length()))])

    def step(at: Column, width: Column) -> Column:
        return F.when(F.get(cuts, at + width)["low"] <= key, at + width).otherwise(at)

    return F.get(cuts, F.aggregate(steps, F.lit(0), step))["span"]


def passes_over(keys: DataFrame, rows: int) -> list[list[date | None]]:
    """All months, in order, in groups of about as many rows."""
    size = max(PASS_ROWS, -(-rows // PASSES))
    if rows <= size:
        return []
    # One row a month.
    counts = sorted(keys.groupBy(MONTH).count().collect(), key=lambda r: (r[0] is not None, r[0]))
    groups, room = [], 0
    for month, n in counts:
        if room <= 0:
            groups.append([])
            room = size
        groups[-1].append(month)
        room -= n
    return groups


def _of_months(df: DataFrame, months: list[date | None]) -> DataFrame:
    named = F.col(MONTH).isin([m for m in months if m is not None])
    return df.where(named | F.col(MONTH).isNull() if None in months else named)


def write_months(
    df: DataFrame,
    path: str,
    cluster_by: list[str],
    keys: DataFrame | None = None,
    mark: str | None = None,
    whole: bool = False,
    before: State | None = None,
    choose: Callable[[DataFrame, list[str]], DataFrame] | None = None,
    finish: Callable[[DataFrame], DataFrame] | None = None,
    stored: bool = False,
) -> None:
    """Replace the months present in ``df``, or with ``whole`` the table, in one step.

    ``keys`` hold month and cluster columns of at least the rows of ``df``; they are read twice,
    so they should come from stored relations. Without them ``df`` is asked, for these columns
    alone. ``mark`` moves with the months; without one it stays what it was.

    Rows of one month and cluster value always meet in one task, so what depends on such rows
    alone needs no shuffle of its own: ``choose`` gets the rows where they meet, and the columns
    they lie by, and returns those to write. ``finish`` gets the rows sorted and works out what
    follows from each alone, so that it need not be shuffled or sorted; it keeps ``span``, month
    and cluster columns as they are. ``stored`` says that ``df`` is no more than stored relations
    put together: then many rows are shuffled some months at a time (`PASS_ROWS`), and all put in
    place together as ever.
    """
    spark = df.sparkSession
    path = path.rstrip("/")
    before = before or read_state(spark, path)
    sweep(spark, path, before)
    keys = (df if keys is None else keys).select(MONTH, *cluster_by)
    load = f"load={before.load + 1}-{uuid.uuid4().hex[:8]}"
    rows = keys.count()
    tasks = min(-(-rows // LEAST_ROWS), spark.sparkContext.defaultParallelism)
    count = max(tasks, -(-rows // FILE_ROWS), 1)
    spans_of(keys, cluster_by, count).coalesce(1).write.parquet(f"{path}/spans/{load}")
    spans = spark.read.parquet(f"{path}/spans/{load}")
    parts = [df]
    if stored and (passes := passes_over(keys, rows)):
        parts = [_of_months(df, months) for months in passes]
    for part in parts:
        kept = _write_spans(part, f"{path}/{load}", spans, cluster_by, count, choose, finish)
        schema = kept.select(*_without_month(kept), MONTH).schema.json()
        del kept
        if stored:
            release(spark)
    # One name a month reaches the driver.
    names = [n.partition("=")[2] for n in subfolders(spark, f"{path}/{load}")]
    others = {} if whole else before.months
    months = {**others, **dict.fromkeys(names, load)}
    superseded = [
        f"{f}/{MONTH}={m}" for m, f in before.months.items() if f and months.get(m) != f
    ]
    after = replace(
        before,
        load=before.load + 1,
        months=months,
        replaced=superseded,
        schema=json.loads(schema),
        cluster_by=cluster_by,
        mark=mark or before.mark,
    )
    commit(spark, path, before, after)


def _without_month(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c != MONTH]


def _write_spans(
    df: DataFrame,
    folder: str,
    spans: DataFrame,
    cluster_by: list[str],
    count: int,
    choose: Callable[[DataFrame, list[str]], DataFrame] | None,
    finish: Callable[[DataFrame], DataFrame] | None,
) -> DataFrame:
    """Write rows by month and span; a task writes one span, in order. Returns what was written."""
    listed = F.sort_array(F.collect_list(F.struct("low", "span"))).alias("cuts")
    # One row a month, of as many entries as the month has files.
    cuts = spans.groupBy(F.col(MONTH).alias("of")).agg(listed)
    placed = df.join(cuts, F.col(MONTH).eqNullSafe(F.col("of")), "left")
    span = F.coalesce(span_of(F.col("cuts"), F.struct(*cluster_by), count), F.lit(0))
    placed = placed.withColumn("span", span).drop("of", "cuts").repartitionById(count, F.col("span"))
    if choose:
        placed = choose(placed, [MONTH, "span", *cluster_by])
    placed = placed.sortWithinPartitions(MONTH, "span", *cluster_by)
    if finish:
        placed = finish(placed)
    # The sorts are part of the plan given, so Spark adds none for the folders.
    written = placed.write.mode("append").option("compression", "zstd")
    written.partitionBy(MONTH, "span").parquet(folder)
    return placed.drop("span")
