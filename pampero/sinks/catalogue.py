"""Documented tables in the catalogue: comments of relations and columns, and their read-back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pampero.sources.schemas import RELATIONS, documented


def save_documented(df: DataFrame, database: str, relation: str, path: str) -> DataFrame:
    """Store a relation as a table that carries its own comment and those of its columns."""
    spark = df.sparkSession
    name = f"{database}.{relation}"
    documented(df).write.mode("overwrite").option("path", path).saveAsTable(name)
    describe(spark, name, RELATIONS.get(relation))
    return spark.table(name)


def describe(spark: SparkSession, name: str, comment: str | None) -> None:
    """Give a table its comment, or take it away."""
    text = "NULL" if comment is None else "'" + comment.replace("\\", "\\\\").replace("'", "\\'") + "'"
    spark.sql(f"COMMENT ON TABLE {name} IS {text}")


def comments(spark: SparkSession, database: str) -> DataFrame:
    """``relation, relation_comment, column, column_comment`` as the catalogue has them.

    Catalogue entries, one a column, not rows of the tables.
    """
    found = []
    for table in spark.catalog.listTables(database):
        if table.isTemporary:
            continue
        name = f"{database}.{table.name}"
        about = spark.catalog.getTable(name).description
        for column in spark.catalog.listColumns(name):
            found.append((table.name, about or None, column.name, column.description or None))
    schema = "relation string, relation_comment string, column string, column_comment string"
    return spark.createDataFrame(found, schema)
