"""The registered queries of this subpackage, and the SQL that must give the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tierwise.llm import alignment, collocations, decontaminate, exact_dedup, html_text, line_dedup, mixing, near_dedup, packing, pii, quality, secrets, substring_dedup

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _query(sql: str | None = None):
    def register(function: Callable[[SparkSession, str], DataFrame]):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


@_query(
    """
    WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS x FROM documents)
    SELECT doc_id, max(doc_id) OVER (PARTITION BY x) AS keep_id, count(*) OVER (PARTITION BY x) AS group_size,
        doc_id = max(doc_id) OVER (PARTITION BY x) AS kept, sha256(x) AS text_sha256
    FROM t
    """
)
def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts."""
    return exact_dedup.exact_groups(_read(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@_query()
def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark, with the item and the place."""
    found = decontaminate.contaminated(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"), "edits", "start", "end")


@_query()
def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, told apart by who has the same value."""
    return secrets.digest_columns(secrets.scan(_read(spark, sf_dir, "documents"))).withColumnRenamed("id", "doc_id")


@_query()
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learnt from the labels that are not held out."""
    docs = _read(spark, sf_dir, "documents")
    model = quality.train(docs, _read(spark, sf_dir, "labels"))
    scored = quality.score(docs.select("doc_id", "text"), model, "score")
    return scored.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


@_query(
    r"""
    WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
    windows AS (SELECT doc_id, i, sha256(array_to_string(ws[i:i + 49], ' ')) AS k FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM w)),
    firsts AS (SELECT k, min(doc_id) AS f FROM windows GROUP BY k),
    gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM windows JOIN firsts USING (k) WHERE f < doc_id),
    words AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM w),
    kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS x, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
    SELECT doc_id, len(ws) AS n_words, len(ws) - coalesce(n, 0) AS n_removed, sha256(coalesce(x, '')) AS kept_sha256
    FROM w LEFT JOIN kept USING (doc_id)
    """
)
def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words left when passages of 50 words that a smaller document has are removed."""
    done = substring_dedup.remove_repeats(_read(spark, sf_dir, "documents"))
    return done.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@_query()
def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document."""
    return pii.digest_columns(pii.scan(_read(spark, sf_dir, "documents"))).withColumnRenamed("id", "doc_id")


@_query(
    r"""
    WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
        unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS i FROM documents),
    k AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
    frequent AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
    SELECT doc_id, count(*) AS n_lines, count(frequent.key) AS n_dropped,
        sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE frequent.key IS NULL), '')) AS kept_sha256
    FROM k LEFT JOIN frequent USING (key) GROUP BY doc_id
    """
)
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts without the lines that ten documents have."""
    done = line_dedup.drop_frequent_lines(_read(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


@_query(
    r"""
    WITH RECURSIVE d AS (
        SELECT doc_id, source, coalesce(text, '') AS x, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
    k AS (SELECT doc_id, source, size, -ln((CAST(concat('0x', substr(sha256(concat('0:', doc_id)), 1, 13)) AS BIGINT) + 1) / 4503599627370496.0::DOUBLE)
        / greatest(0.05::DOUBLE, CASE WHEN x = '' THEN 1.0::DOUBLE
            ELSE length(translate(x, '!"#$%&*+<=>@[\]^_{|}~0123456789', ''))::DOUBLE / length(x) END) AS key FROM d),
    r AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY key, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM k),
    s AS (SELECT source, sum(size)::DOUBLE AS source_size, ([3.0, 1.0, 2.0])[1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS w
        FROM d GROUP BY source),
    lev AS (SELECT 0 AS i, 1.5 * sum(source_size) / sum(w) AS lvl FROM s
        UNION ALL
        SELECT i + 1, (1.5 * sum(source_size) - coalesce(sum(2 * source_size) FILTER (WHERE 2 * source_size <= w * lvl), 0))
            / sum(w) FILTER (WHERE 2 * source_size > w * lvl) FROM lev, s WHERE i < 25 GROUP BY i, lvl),
    t AS (SELECT source, source_size, least(2 * source_size, w * (SELECT max(lvl) FROM lev)) AS target FROM s),
    e AS (SELECT doc_id, size, before, source_size, target, floor(target / source_size) AS epochs FROM r JOIN t ON r.source IS NOT DISTINCT FROM t.source)
    SELECT doc_id, size, source_size::BIGINT AS source_size, target,
        (epochs * size + greatest(0, least(size, floor(target) - epochs * source_size - before)))::BIGINT AS taken FROM e
    """
)
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of all sources takes of every document."""
    return mixing.mix(_read(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@_query()
def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html_text.extract(_read(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


@_query()
def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprint and component of every document."""
    found = near_dedup.near_duplicates(_read(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@_query()
def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of two tokenizers over every document, with corpus-wide link counts."""
    found = alignment.align(_read(spark, sf_dir, "documents"))
    return found.withColumnsRenamed({"id": "doc_id", "groups": "groups_sha256"})


@_query(
    r"""
    WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
    w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
    totals AS (SELECT lang, sum(len(ws)) AS n FROM w GROUP BY lang),
    f AS (SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase, count(*) AS f
        FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM w, range(1, 6) t(k) WHERE len(ws) >= k) GROUP BY ALL HAVING count(*) >= 100),
    c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1),
    inside AS (SELECT lang, array_to_string(ws[i:i + m - 1], ' ') AS phrase, max(a) AS within
        FROM (SELECT *, unnest(range(1, k - m + 2)) AS i FROM c, range(2, 5) t(m) WHERE m < k) GROUP BY ALL),
    cuts AS (SELECT c.lang, c.phrase, a, n, cut, x.f AS l, y.f AS r, (1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f) AS score
        FROM (SELECT *, unnest(range(1, k)) AS cut FROM c) c JOIN totals USING (lang)
        JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(ws[1:cut], ' ')
        JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(ws[cut + 1:], ' ')),
    best AS (SELECT * FROM cuts LEFT JOIN inside USING (lang, phrase) WHERE coalesce(within, 0) * 100 < a * 100
        QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1)
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score
    FROM best QUALIFY rank <= 2000
    """
)
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The phrases of each language whose words belong together most."""
    return collocations.collocations(_read(spark, sf_dir, "documents"))


@_query()
def op13_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every piece of every document in sequences of 1024 tokens."""
    return packing.pack(_read(spark, sf_dir, "documents")).withColumnsRenamed({"id": "doc_id", "crc": "ids_crc32"})
