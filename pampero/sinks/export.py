"""Export of relations as newline-delimited JSON with a manifest."""

from __future__ import annotations

from datetime import datetime, timezone
from decimal import Decimal
from functools import reduce
from pathlib import PurePosixPath

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Kinds of catalogue entries that can be exported; temporary views are left out.
EXPORTABLE = {"MANAGED": "TABLE", "EXTERNAL": "TABLE", "VIEW": "VIEW"}


class Relations(dict):
    """Relations by export name, with how they were found and what each is in the catalogue."""

    def __init__(self, mode: str):
        super().__init__()
        self.mode = mode
        self.kinds: dict[str, str] = {}
        self.names: dict[str, str] = {}

    def add(self, spark: SparkSession, relation: str, name: str) -> None:
        kind = spark.catalog.getTable(name).tableType
        self[relation] = spark.table(name)
        self.kinds[relation] = EXPORTABLE.get(kind, "VIEW")
        self.names[relation] = name


def discover(spark: SparkSession, databases: list[str]) -> Relations:
    """Every exportable table and view of the databases, as ``database/table``.

    Databases are taken once, in order; one that does not exist is skipped.
    """
    found = Relations("auto")
    for database in dict.fromkeys(databases):
        if not spark.catalog.databaseExists(database):
            continue
        for entry in spark.catalog.listTables(database):
            if entry.tableType in EXPORTABLE and not entry.isTemporary:
                found.add(spark, f"{database}/{entry.name}", f"{database}.{entry.name}")
    return found


def named_tables(spark: SparkSession, names: dict[str, str]) -> Relations:
    """Relations from an explicit map of export name to table name."""
    if not names:
        raise ValueError("name at least one table to export")
    found = Relations("explicit")
    for out, name in names.items():
        found.add(spark, out.removesuffix(".json"), name)
    return found


def _digest(line: Column) -> Column:
    """A digest of lines in any order: which of them there are, and how often."""
    return F.sum(F.xxhash64(line).cast("decimal(20,0)"))


def write_ndjson(df: DataFrame, path: str) -> tuple[int, Decimal | None]:
    """One JSON object per line, NULL members left out; returns the number and digest of rows.

    Both are taken while rows are written, without a second read.
    """
    written = Observation()
    lines = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "true"})
    (
        df.observe(written, F.count(F.lit(1)).alias("rows"), _digest(lines).alias("digest"))
        .write.mode("overwrite")
        .option("ignoreNullFields", True)
        .json(path)
    )
    return written.get["rows"], written.get["digest"]


def read_back(spark: SparkSession, out: str, relation: str) -> DataFrame:
    """``relation, file, rows, digest`` of the exported files as they lie there now.

    Lines are hashed where they are read and added up by file.
    """
    lines = spark.read.option("pathGlobFilter", "*.json").text(f"{out}/{relation}")
    file = F.regexp_extract("_metadata.file_path", r"([^/]+)$", 1).alias("file")
    held = lines.groupBy(file).agg(F.count(F.lit(1)).alias("rows"), _digest(F.col("value")).alias("digest"))
    return held.select(F.lit(relation).alias("relation"), "file", "rows", "digest")


def damaged(spark: SparkSession, out: str, manifest_name: str = "export_manifest") -> DataFrame:
    """Exported files that are not what the manifest says: ``relation, file, found_rows,
    listed_rows``, either of them NULL for a file that is missing or unknown."""
    listed = spark.read.schema(FILES).json(f"{out}/{manifest_name}_files")
    names = [r[0] for r in listed.select("relation").distinct().collect()]
    found = reduce(DataFrame.unionByName, [read_back(spark, out, n) for n in names])
    found = found.select("relation", "file", F.col("rows").alias("found_rows"), F.col("digest").alias("now"))
    both = listed.where("rows > 0").join(found, ["relation", "file"], "full")
    same = F.col("rows").eqNullSafe(F.col("found_rows")) & F.col("digest").eqNullSafe(F.col("now"))
    return both.where(~same).select("relation", "file", "found_rows", F.col("rows").alias("listed_rows"))


#: One exported file in the manifest's list.
FILES = "relation string, file string, bytes bigint, rows bigint, digest decimal(30,0)"


def exported_files(spark: SparkSession, out: str, relation: str) -> DataFrame:
    """Name, size, rows and digest of each exported file, read back."""
    listing = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.json")
        .load(f"{out}/{relation}")
    )
    sizes = listing.select(
        F.regexp_extract("path", r"([^/]+)$", 1).alias("file"), F.col("length").alias("bytes")
    )
    return sizes.join(read_back(spark, out, relation).drop("relation"), "file", "left").select(
        F.lit(relation).alias("relation"),
        "file",
        "bytes",
        F.coalesce("rows", F.lit(0)).alias("rows"),
        F.coalesce("digest", F.lit(0)).cast("decimal(30,0)").alias("digest"),
    )


def export(
    spark: SparkSession,
    relations: dict[str, DataFrame],
    out: str,
    manifest_name: str = "export_manifest",
) -> DataFrame:
    """Export every relation to ``out/<dataset>/<table>`` and write the manifest.

    Two manifest tables are written: the runs, one line per relation with file and row count,
    and beside it ``<manifest_name>_files``, one line per file in name order. The file list
    is a table of its own because it grows with the data. Files are read back: the list has rows
    and a digest of each, and a relation is ``is_whole`` if they add up to what was written
    (`damaged` tells later). A run names its mode by how the
    relations were found: ``auto`` if discovered. A stored table is scanned, a view or a plain
    DataFrame is a query.
    """
    mode = getattr(relations, "mode", "explicit")
    kinds, names = getattr(relations, "kinds", {}), getattr(relations, "names", {})
    if manifest_name in ("", ".", "..") or PurePosixPath(manifest_name).name != manifest_name:
        raise ValueError(f"not a single path component: {manifest_name!r}")
    generated_at = datetime.now(timezone.utc).isoformat()
    records, files = [], None
    for relation, df in relations.items():
        rows, digest = write_ndjson(df, f"{out}/{relation}")
        dataset, _, table = relation.rpartition("/")
        kind = kinds.get(relation, "QUERY")
        method = "scan" if kind == "TABLE" else "query"
        name = names.get(relation, relation.replace("/", "."))
        records.append((relation, dataset, table, name, kind, method, rows, digest))
        listing = exported_files(spark, out, relation)
        files = listing if files is None else files.unionByName(listing)
    listed = f"{out}/{manifest_name}_files"
    files.orderBy("relation", "file").write.mode("overwrite").json(listed)
    counted = spark.read.schema(FILES).json(listed).groupBy("relation").agg(
        F.count("*").alias("file_count"), F.sum("rows").alias("held"), F.sum("digest").alias("sum")
    )
    header = spark.createDataFrame(
        records,
        "relation string, dataset string, table string, qualified_name string, "
        "relation_type string, export_method string, row_count bigint, digest decimal(30,0)",
    )
    same_rows = F.coalesce("held", F.lit(0)) == F.col("row_count")
    same_lines = F.coalesce("sum", F.lit(0)) == F.coalesce("digest", F.lit(0))
    manifest = header.join(counted, "relation", "left").select(
        F.lit(generated_at).alias("generated_at"),
        F.lit(mode).alias("mode"),
        "dataset",
        "table",
        "qualified_name",
        "relation_type",
        "export_method",
        F.concat(F.lit(f"{out}/"), "relation", F.lit("/*.json")).alias("files"),
        F.coalesce("file_count", F.lit(0)).alias("file_count"),
        "row_count",
        (same_rows & same_lines).alias("is_whole"),
    )
    path = f"{out}/{manifest_name}"
    manifest.orderBy("dataset", "table").coalesce(1).write.mode("overwrite").json(path)
    return spark.read.schema(manifest.schema).json(path)
