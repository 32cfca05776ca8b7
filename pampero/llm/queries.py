"""The operators as registered queries, with SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pampero.llm import (
    bpe,
    decontamination,
    exact_dedup,
    language_id,
    language_model,
    line_dedup,
    ngram_join,
    periodic_runs,
    resampling,
    source_mix,
    suffix_dedup,
    toxicity,
    warc,
)
from pampero.llm.common import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(function: Callable[[SparkSession, str], DataFrame]):
    QUERIES[function.__name__] = lambda spark, sf_dir: function(prepare(spark), sf_dir)
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(n: int) -> Column:
    """Which of n folds a document is in."""
    return F.crc32(F.col("doc_id").cast("string")) % n


#: Words between separators of ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: A text lower-cased in A-Z alone, in SQL.
ASCII_LOWER = (
    "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
)


@register
def op1_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score_texts(
        table(spark, sf_dir, "documents"),
        learn_from=remainder(5) != 1,
        rounds=[remainder(5) == r for r in (0, 2, 3, 4)],
    )


@register
def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    file = public_tokenizers.path("byte_bpe_50k.json")
    encoded = bpe.encode_texts(table(spark, sf_dir, "documents"), file, outputs=False)
    return encoded.drop("ids", "decoded")


@register
def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.decontaminate(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10
    ).drop("hit_spans")


WORD_LIST = f"regexp_extract_all({ASCII_LOWER}, '{WORD}')"

ORACLES["op3_decontamination"] = f"""
WITH docs AS (SELECT doc_id, {WORD_LIST} AS w FROM documents),
items AS (SELECT item_id, {WORD_LIST} AS w FROM benchmark),
sized AS (SELECT item_id, w, least(len(w), 10) AS n FROM items WHERE len(w) > 0),
windows AS (
    SELECT DISTINCT item_id, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS words
    FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM sized)
),
spans AS (
    SELECT doc_id, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS words
    FROM (
        SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM docs, (SELECT DISTINCT n FROM sized) WHERE len(w) >= n
    )
),
met AS (SELECT doc_id, item_id, n, i FROM spans JOIN windows USING (n, words)),
hit AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM met) GROUP BY doc_id
),
named AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM met) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""


@register
def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"), keep="largest")


ORACLES["op4_exact_dedup"] = """
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
kept AS (SELECT text, max(doc_id) AS keep_id, count(*) AS group_size FROM texts GROUP BY text)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(text) AS text_sha256
FROM texts JOIN kept USING (text)
"""


@register
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.dedup_lines(table(spark, sf_dir, "documents"), edits=2, min_chars=20)
    return cleaned.select(
        "doc_id",
        "n_lines",
        "n_dropped",
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


ORACLES["op5_line_dedup"] = """
WITH lines AS (
    SELECT doc_id, i, line FROM (
        SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
            generate_subscripts(string_split(text, chr(10)), 1) AS i
        FROM documents WHERE text <> ''
    )
),
long AS (SELECT * FROM lines WHERE length(line) >= 20),
kinds AS (
    SELECT line, length(line)::INT AS n, min(struct_pack(doc_id := doc_id, i := i)) AS first
    FROM long GROUP BY line
),
thirds AS (
    SELECT line, n, k, substr(line, (n * k // 3) + 1, n * (k + 1) // 3 - n * k // 3) AS part
    FROM kinds, range(3) AS t(k)
),
probes AS (
    SELECT line, first, n - less AS n, k,
        substr(line, ((n - less) * k // 3) + 1 + shift, (n - less) * (k + 1) // 3 - (n - less) * k // 3) AS part
    FROM kinds, range(3) AS d(less), range(3) AS t(k), range(-2, 3) AS s(shift)
    WHERE ((n - less) * k // 3) + 1 + shift >= 1
),
met AS (
    SELECT DISTINCT a.line AS a, b.line AS b FROM probes AS a JOIN thirds AS b USING (n, k, part)
    WHERE a.line <> b.line
),
near AS (SELECT a, b FROM met WHERE levenshtein(a, b) <= 2),
late AS (
    SELECT DISTINCT CASE WHEN x.first > y.first THEN a ELSE b END AS line
    FROM near JOIN kinds AS x ON x.line = a JOIN kinds AS y ON y.line = b
),
gone AS (
    SELECT l.doc_id, l.i FROM long AS l JOIN kinds AS k USING (line)
    WHERE struct_pack(doc_id := l.doc_id, i := l.i) <> k.first OR l.line IN (FROM late)
),
kept AS (
    SELECT doc_id, string_agg(line, chr(10) ORDER BY i) AS text, count(*) AS n_kept
    FROM lines ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
),
counted AS (SELECT doc_id, count(*) AS n_lines FROM lines GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_lines, 0) - coalesce(n_kept, 0) AS n_dropped,
    sha256(coalesce(kept.text, '')) AS kept_sha256
FROM documents AS d LEFT JOIN counted USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


@register
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(
        table(spark, sf_dir, "documents"),
        table(spark, sf_dir, "labels"),
        learn_from=remainder(5) != 0,
    )


@register
def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), length=50)


ORACLES["op7_suffix_dedup"] = """
WITH texts AS (
    SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents
),
windows AS (
    SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS w
    FROM (SELECT doc_id, h, unnest(range(0, n - 49)) AS i FROM texts)
),
firsts AS (SELECT w, min(doc_id) AS first_id FROM windows GROUP BY w),
met AS (SELECT doc_id, i FROM windows JOIN firsts USING (w) WHERE first_id < doc_id),
marked AS (
    SELECT doc_id, i,
        CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50 THEN 0 ELSE 1 END AS new
    FROM met
),
numbered AS (
    SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM marked
),
runs AS (
    SELECT doc_id, run, min(i) AS low, max(i) + 50 AS high FROM numbered GROUP BY doc_id, run
),
gaps AS (
    SELECT doc_id, low, high, coalesce(lag(high) OVER (PARTITION BY doc_id ORDER BY low), 0) AS behind
    FROM runs
),
kept AS (
    SELECT doc_id, string_agg(substr(h, 2 * behind + 1, 2 * (low - behind)), '' ORDER BY low)
            || substr(any_value(h), 2 * max(high) + 1) AS rest,
        sum(high - low)::BIGINT AS n_removed, count(*) AS n_spans
    FROM gaps JOIN texts USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
    sha256(unhex(coalesce(rest, h))) AS kept_sha256
FROM texts LEFT JOIN kept USING (doc_id)
"""


@register
def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"), k=5, percent=80)


ORACLES["op8_ngram_join"] = f"""
WITH RECURSIVE docs AS (
    SELECT doc_id, regexp_extract_all({ASCII_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents
),
shingles AS (
    SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS s
    FROM (
        SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM docs WHERE len(w) > 0
    )
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
meetings AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both_have
    FROM shingles AS a JOIN shingles AS b USING (s) WHERE a.doc_id <> b.doc_id GROUP BY ALL
),
links AS (
    SELECT a, b FROM meetings JOIN sizes AS x ON x.doc_id = a JOIN sizes AS y ON y.doc_id = b
    WHERE 100 * both_have >= 80 * (x.n + y.n - both_have)
),
reach AS (
    SELECT a AS doc_id, b AS other FROM links
    UNION
    SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, min(other)) AS component_id
FROM docs AS d LEFT JOIN sizes USING (doc_id) LEFT JOIN reach ON reach.doc_id = d.doc_id
GROUP BY d.doc_id, n
"""


@register
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"), learn_from=remainder(3) != 1)


@register
def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_and_read(table(spark, sf_dir, "pages"), min_bytes=0)


ORACLES["op10_warc"] = """
WITH payloads AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex,
        min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_id
    FROM pages
),
quintets AS (
    SELECT page_id, i,
        ((('0x' || substr(hex, ((i // 8) * 10 + 1)::INT, 10))::BIGINT >> (35 - 5 * (i % 8))) & 31)::INT AS v
    FROM payloads, range(32) AS r(i)
),
digests AS (
    SELECT page_id, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', v + 1, 1), '' ORDER BY i)
        AS payload_digest
    FROM quintets GROUP BY page_id
)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM payloads JOIN digests USING (page_id)
"""


@register
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)
    n = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(source_mix.WORD)).cast("long")
    at = F.pmod(g, n)
    span = 1 + F.floor((n - at) / (3 + g % 8))
    loops = F.when((h % 10 == 0) & (n > 0), F.struct(at.alias("at"), span.alias("span")))
    found = periodic_runs.detect_runs(table(spark, sf_dir, "documents"), loops, outputs=False)
    return found.drop("n_words")


@register
def op12_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = source_mix.mix_sources(table(spark, sf_dir, "documents"), weights=[3, 1, 2])
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def _spent(number: int) -> str:
    """One pass of the mix: what fits each source's room in the order of hashes, and its cut."""
    before = f"pass{number - 1}" if number > 1 else "budgets"
    pool = (
        f"FROM run{number - 1} AS r JOIN pass{number - 1} USING (source_key)"
        " WHERE r.hash > cut_hash AND r.size <= room"
        if number > 1
        else "FROM rows AS r WHERE size > 0"
    )
    return f"""
run{number} AS (
    SELECT r.doc_id, r.source_key, r.hash, r.size,
        sum(r.size) OVER (PARTITION BY r.source_key ORDER BY r.hash) AS upto
    {pool}
),
pass{number} AS (
    SELECT source_key, arg_min(hash, hash) AS cut_hash, arg_min(size, hash) AS cut_size,
        arg_min(b.room - upto + size, hash) AS room
    FROM run{number} JOIN {before} AS b USING (source_key) WHERE upto > b.room GROUP BY source_key
)"""


def _taken(number: int, rest: str) -> str:
    """What a pass takes: all before its cut, and the last cut if that is nearer."""
    return f"""SELECT doc_id FROM run{number} LEFT JOIN pass{number} USING (source_key) LEFT JOIN {rest} USING (source_key)
    WHERE cut_hash IS NULL OR hash < cut_hash
        OR hash = cut_hash AND room >= coalesce(rest, 0) AND 2 * (room - coalesce(rest, 0)) >= cut_size"""


ORACLES["op12_source_mix"] = f"""
WITH rows AS (
    SELECT doc_id, (source IS NULL)::INT || coalesce(source, '') AS source_key,
        len(regexp_extract_all(coalesce(text, ''), '{source_mix.WORD}'))::BIGINT AS size,
        ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')), 1, 15))::BIGINT AS hash
    FROM documents
),
sources AS (
    SELECT source_key, sum(size)::BIGINT AS source_size, 2.0::DOUBLE * sum(size)::DOUBLE AS top,
        [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY source_key) - 1) % 3 + 1)::INT]::DOUBLE AS weight
    FROM rows GROUP BY source_key
),
-- Were this source and all of higher top / weight to share what the others leave: the first one
-- that does not exceed its ceiling then sets the level.
levels AS (
    SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(top) OVER low, 0))
        / sum(weight) OVER (ORDER BY top / weight DESC, source_key DESC) AS level
    FROM sources
    WINDOW low AS (ORDER BY top / weight, source_key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
targets AS (
    SELECT source_key, source_size,
        least(top, weight * (
            SELECT level FROM levels WHERE level <= top / weight ORDER BY top / weight, source_key LIMIT 1
        )) AS target
    FROM sources
),
budgets AS (
    SELECT source_key, source_size, target,
        CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole,
        CASE WHEN source_size > 0 THEN target - floor(target / source_size) * source_size ELSE 0 END AS room
    FROM targets
),
{_spent(1)},
{_spent(2)},
{_spent(3)},
rest1 AS (SELECT source_key, sum(size) AS rest FROM run2 GROUP BY source_key),
rest2 AS (SELECT source_key, sum(size) AS rest FROM run3 GROUP BY source_key),
rest3 AS (SELECT source_key, 0 AS rest FROM sources),
more AS (
    {_taken(1, "rest1")}
    UNION ALL
    {_taken(2, "rest2")}
    UNION ALL
    {_taken(3, "rest3")}
)
SELECT doc_id, size, source_size, target,
    (size * (whole + (doc_id IN (SELECT doc_id FROM more))::INT))::BIGINT AS taken
FROM rows JOIN budgets USING (source_key)
"""


@register
def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.drop("n_words")
