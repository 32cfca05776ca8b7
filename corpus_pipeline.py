"""From raw documents to token ids: five stages, each over all that the one before it kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pampero.llm import bpe, decontamination, line_dedup, ngram_join, toxicity
from pampero.llm.common import STAGED, prepare, stage, text_bytes
from pampero.workspace import discard, new_path

#: The columns of documents, which all stages but the last return.
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def numbered(docs: DataFrame, name: str) -> DataFrame:
    """Documents with a stored number of each row, since ids may be null or repeated."""
    return stage(docs.select(*COLUMNS, F.monotonically_increasing_id().alias("row")), name)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not predicted toxic. The machine learns from the labels of all folds but one, on
    the documents given."""
    prepare(spark)
    fold = F.crc32(F.col("doc_id").cast("string")) % 5
    machine = toxicity.train(
        docs.select("doc_id", "text"), read(spark, sf_dir, "labels"), F.coalesce(fold != 0, F.lit(False))
    )
    if machine is None:
        return docs.select(*COLUMNS)
    scored = toxicity.apply(
        docs.select(*COLUMNS, text_bytes().alias("body")), machine, COLUMNS
    )
    return scored.where("predicted = 0").select(*COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that an earlier line nearly equals; ``n_chars`` anew where
    the text changed."""
    prepare(spark)
    cleaned = line_dedup.dedup_lines(docs.select(*COLUMNS))
    n_chars = F.when(F.col("n_dropped") > 0, F.char_length("text")).otherwise(F.col("n_chars"))
    kind = docs.schema["n_chars"].dataType
    return cleaned.select(
        *[n_chars.cast(kind).alias(c) if c == "n_chars" else F.col(c) for c in COLUMNS]
    )


def keep_one_of_alike(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the row with the smallest id, those without id last;
    rows without words are alike to none and stay."""
    prepare(spark)
    rows = numbered(docs, "rows-to-join")
    groups = ngram_join.jaccard_components(rows.select(F.col("row").alias("doc_id"), "text"))
    group = F.coalesce("component_id", "doc_id").alias("group")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row"))
    stay = (
        groups.select(F.col("doc_id").alias("row"), group)
        .join(rows.select("row", F.col("doc_id").alias("id")), "row")
        .groupBy("group")
        .agg(first.alias("first"))
        .select(F.col("first.row").alias("row"))
    )
    return rows.join(stay, "row", "left_semi").select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window of ten words with the benchmark."""
    prepare(spark)
    rows = numbered(docs, "rows-to-judge")
    judged = decontamination.decontaminate(
        rows.select(F.col("row").alias("doc_id"), "text"), read(spark, sf_dir, "benchmark")
    )
    hit = judged.where("contaminated").select(F.col("doc_id").alias("row"))
    return rows.join(hit, "row", "left_anti").select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, as little-endian unsigned 32-bit integers."""
    import public_tokenizers

    prepare(spark)
    file = public_tokenizers.path("byte_bpe_50k.json")
    return bpe.encode_texts(docs.select("doc_id", "text"), file).select(
        "doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"
    )


#: What the last stage staged.
LEFT: list[str] = []


def tidy(step: Callable[[SparkSession, DataFrame, str], DataFrame]):
    """A stage that first deletes what the one before it staged.

    Its result is written and read again by then, and given as ``docs``; if it still reads what was
    staged, nothing is deleted.
    """

    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        left, LEFT[:] = [*LEFT], []
        if left and any(path in file for file in docs.inputFiles() for path in left):
            STAGED.extend(left)
        else:
            for path in left:
                discard(spark, path)
        before = len(STAGED)
        result = step(spark, docs, sf_dir)
        LEFT[:] = STAGED[before:]
        del STAGED[before:]
        return result

    run_stage.__name__, run_stage.__doc__ = step.__name__, step.__doc__
    return run_stage


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", tidy(drop_toxic)),
    ("line dedup", tidy(drop_repeated_lines)),
    ("n-gram Jaccard join", tidy(keep_one_of_alike)),
    ("benchmark decontamination", tidy(drop_contaminated)),
    ("BPE encoding and decoding", tidy(encode)),
]

#: Neither learned scores nor token ids can be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over documents; each result is written and read again."""
    docs, before = read(spark, sf_dir, "documents"), None
    for name, step in STAGES[:-1]:
        path = new_path(spark, name.replace(" ", "-"))
        step(spark, docs, sf_dir).write.parquet(path)
        if before:
            discard(spark, before)
        docs, before = spark.read.parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
