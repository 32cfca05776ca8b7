"""Extraction of columns from the nested payload of a raw snapshot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


PREFIX = "payload_"


#: The payload as JSON text, NULL where members came as columns or struct fields.
DOCUMENT = "payload__document"


def scalar_text(value: Column, name: str) -> Column:
    """Text of a payload member, NULL where it holds an object or an array.

    ``from_json`` hands nested values over as their JSON text, which plain text may look
    like. So values that begin with a bracket, and only these, are looked up again in the document:
    a branch of its own, since conditions joined by ``|`` are all worked out for every row. The
    member alone is read as a VARIANT, which knows its type; the document as a whole may not be one,
    for repeating a key.
    """
    document = F.col(DOCUMENT)
    member = F.from_json(document, T.StructType([T.StructField(name, T.VariantType())]))[name]
    is_text = F.when(document.isNull(), True).otherwise(F.schema_of_variant(member) == "STRING")
    return _unless_nested(value, is_text)


def _unless_nested(value: Column, is_text: Column) -> Column:
    """A value, if it does not begin like an object or array, or else if it is text."""
    bracket = value.startswith("{") | value.startswith("[")
    return F.when(bracket, F.when(is_text, value)).otherwise(value)


def with_payload(df: DataFrame, members: T.StructType) -> DataFrame:
    """Replace `data` by one text column per member, named ``payload_<member>``, and the
    document in `DOCUMENT`.

    * There is no `data`: members are columns already, as in the loader's flattened view.
    * `data` is a struct: members are read in place, so the Parquet scan fetches only those
      that are used later. Members it lacks are NULL.
    * `data` is JSON text: it is parsed once per row under the declared schema, not once per
      member. The parse sits in a generator because filters on members would otherwise be
      pushed below it, each with a parse of its own.
    * `data` is a VARIANT: each member is fetched by its path, and nothing is parsed. Nested
      values are NULL.
    """
    names = members.fieldNames()
    kept = [c for c in df.columns if c != "data"]
    if "data" not in df.columns:
        kept = [c for c in kept if c not in names]
        flat = [_column(df, n).alias(PREFIX + n) for n in names]
        return df.select(*kept, *flat, F.lit(None).cast("string").alias(DOCUMENT))
    kind = df.schema["data"].dataType
    if isinstance(kind, T.StructType):
        columns = {PREFIX + n: _member(kind, n) for n in names}
        columns[DOCUMENT] = F.lit(None).cast("string")
        return df.withColumns(columns).drop("data")
    if isinstance(kind, T.VariantType):
        columns = {PREFIX + n: _at_path(n) for n in names}
        columns[DOCUMENT] = F.lit(None).cast("string")
        return df.withColumns(columns).drop("data")
    text = F.col("data")
    parsed = F.inline_outer(F.array(F.from_json(text, members))).alias(*[PREFIX + n for n in names])
    return df.select(*kept, text.alias(DOCUMENT), parsed)


def _at_path(name: str) -> Column:
    """A member of a VARIANT as text, typed at its path; NULL where it holds an object or array."""
    path = f"$['{name}']"
    member = F.try_variant_get("data", path, "variant")
    is_text = F.schema_of_variant(member) == "STRING"
    return _unless_nested(F.try_variant_get("data", path, "string"), is_text)


def _member(kind: T.StructType, name: str) -> Column:
    if name not in kind.fieldNames():
        return F.lit(None).cast("string")
    value = F.col("data").getField(name)
    if isinstance(kind[name].dataType, (T.StructType, T.ArrayType, T.MapType)):
        return F.lit(None).cast("string")
    return value.cast("string")


def _column(df: DataFrame, name: str) -> Column:
    value = F.col(name) if name in df.columns else F.lit(None)
    return value.cast("string")


def text_member(name: str) -> Column:
    """Member kept as text."""
    return scalar_text(F.col(PREFIX + name), name)


def raw_member(name: str) -> Column:
    """Member to be cast: a nested value fails the cast and becomes NULL by itself."""
    return F.col(PREFIX + name)
