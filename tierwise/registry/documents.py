"""Movie documents derived from ``part`` and ``supplier``, in Spark and in SQL.

Every part gives one document. The field rules are arithmetic on the part key, so that SQL can
repeat them; together they hit each special case of the models (unknown and equal amounts, bad dates,
missing status, empty and missing arrays, tied ratings). Parts of size 46 and up are sent again a day
later with a higher revenue; parts of size 1 are later delisted.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tierwise.functions.dates import moment
from tierwise.plans import bronze, gold, silver
from tierwise.plans.reference_data import SOURCE_URL, STUDIO_TIERS
from tierwise.registry.catalog import half_up, read, season_sql
from tierwise.sources.documents import land_snapshot, parse_documents, stamp_batch
from tierwise.sources.shared_folder import cut_lineage

AS_OF = dt.datetime(2024, 2, 1)
FIRST = dt.datetime(2024, 1, 1)
SECOND = dt.datetime(2024, 1, 2)

# Genre ids and names of the public movie catalogue.
GENRES = [
    (28, "Action"), (12, "Adventure"), (16, "Animation"), (35, "Comedy"), (80, "Crime"),
    (99, "Documentary"), (18, "Drama"), (10751, "Family"), (14, "Fantasy"), (36, "History"),
    (27, "Horror"), (10402, "Music"), (9648, "Mystery"), (10749, "Romance"),
    (878, "Science Fiction"), (10770, "TV Movie"), (53, "Thriller"), (10752, "War"),
    (37, "Western"),
]
COUNTRIES = ["us", "GB", "FR", "JP", "BR", ""]
STUDIOS = list(STUDIO_TIERS)


def loaded_at() -> Column:
    return moment(AS_OF)


def _sql_list(values: list, opening: str = "[", closing: str = "]") -> str:
    quoted = ["'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v) for v in values]
    return opening + ", ".join(quoted) + closing


def _pick(values: list, index: str) -> str:
    return f"element_at({_sql_list(values, 'array(', ')')}, CAST({index} AS INT) + 1)"


def _entries(count: str, entry: str) -> str:
    return f"CASE WHEN {count} > 0 THEN transform(sequence(0, greatest(CAST({count} AS INT), 1) - 1), i -> {entry}) END"


_BUDGET = "CASE WHEN k % 7 = 0 THEN 0 ELSE k * 7919009 % 200000000 END"


def _document(suppliers: int, added_revenue: int) -> str:
    """Spark SQL for the JSON text of one document."""
    genre, company = f"(k + 5 * i) % {len(GENRES)}", f"(k + i) % {suppliers}"
    genre_entry = (
        f"named_struct('id', {_pick([g[0] for g in GENRES], genre)}, 'name', {_pick([g[1] for g in GENRES], genre)})"
    )
    company_entry = f"""named_struct('id', {company} + 1,
        'name', CASE WHEN {company} % 20 < 16 THEN {_pick(STUDIOS, f"{company} % 20 % 16")}
                     ELSE concat(' Studio ', {company}) END,
        'origin_country', {_pick(COUNTRIES, f"{company} % 6")})"""
    return f"""to_json(named_struct(
      'id', k + 1,
      'title', CASE WHEN k % 97 = 0 THEN '' ELSE concat('  ', p_name, ' ', k, ' ') END,
      'original_title', p_name,
      'tagline', CASE WHEN k % 3 = 0 THEN '' ELSE concat(' Tag ', k) END,
      'overview', concat(p_type, ' of size ', p_size),
      'homepage', CASE WHEN k % 4 = 0 THEN concat('https://movies.example.org/', k) END,
      'imdb_id', concat('tt', lpad(CAST(k AS STRING), 7, '0')),
      'release_date', CASE WHEN k % 41 = 0 THEN '' WHEN k % 53 = 0 THEN '2023-02-30'
          ELSE CAST(date_add(DATE '1980-01-01', CAST(k * 37 % 16800 AS INT)) AS STRING) END,
      'budget', budget,
      'revenue', {added_revenue} + CASE WHEN (k + 1) % 59 = 0 AND budget > 0 THEN budget
          WHEN k % 5 = 0 THEN 0 ELSE k * 104729003 % 900000000 END,
      'runtime', CASE WHEN k % 11 = 0 THEN 0 ELSE 60 + 2 * p_size END,
      'popularity', p_retailprice / 10,
      'vote_average', k * 31 % 101 / 10D,
      'vote_count', k * 13 % 500,
      'status', CASE WHEN k % 19 = 0 THEN 'Rumored' WHEN k % 23 <> 0 THEN 'Released' END,
      'original_language', CASE WHEN p_size <= 25 THEN 'en' ELSE 'fr' END,
      'adult', k % 2,
      'genres', CASE WHEN k % 8 = 0 THEN CAST(array() AS ARRAY<STRUCT<id: INT, name: STRING>>)
          ELSE {_entries("k % 4", genre_entry)} END,
      'production_companies', {_entries("k % 3", company_entry)}))"""


def document_lines(spark: SparkSession, sf_dir: str, resent: bool = False) -> DataFrame:
    """One line of JSON per part; ``resent`` gives the second batch."""
    suppliers = read(spark, sf_dir, "supplier").count()
    part = read(spark, sf_dir, "part").selectExpr("p_partkey AS k", "p_name", "p_type", "p_size", "p_retailprice")
    if resent:
        part = part.filter("p_size >= 46")
    # Building and parsing documents is the work here; a small table would otherwise be one task.
    part = part.repartition("k")
    document = _document(suppliers, 1000000 if resent else 0)
    return part.selectExpr("*", f"{_BUDGET} AS budget").selectExpr(f"{document} AS value")


def batch(spark: SparkSession, sf_dir: str, resent: bool = False) -> DataFrame:
    documents, _ = parse_documents(document_lines(spark, sf_dir, resent))
    number, at = ("batch-2", SECOND) if resent else ("batch-1", FIRST)
    return stamp_batch(documents, number, at, SOURCE_URL)


def raw_movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both batches, so that resent movies occur twice."""
    return batch(spark, sf_dir).unionByName(batch(spark, sf_dir, resent=True))


def bronze_movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze.bronze_movies_raw(cut_lineage(raw_movies(spark, sf_dir)))


def genre_list(documents: DataFrame) -> DataFrame:
    """The reference list: the genres named in the documents, landed as one array.

    It has at most one entry per catalogue genre, so it is small enough for one row.
    """
    named = silver.silver_movie_genres(documents, loaded_at())
    listed = named.select(F.col("genre_id").alias("id"), F.col("genre_name_raw").alias("name")).distinct()
    entries = F.array_sort(F.collect_list(F.struct("id", "name")))
    text = listed.agg(F.to_json(entries).alias("text")).first()["text"]
    return land_snapshot(documents.sparkSession, text, "batch-1", FIRST)


class Movies:
    """The tables of the warehouse as one query's DataFrames.

    Those that several models read are written once, as in the stored warehouse.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, keep_fact: bool = False):
        at = loaded_at()
        # No model reads the hash of a document, which costs more than parsing it.
        self.bronze = cut_lineage(bronze_movies(spark, sf_dir).drop("row_hash"))
        self.movies = silver.silver_movies(self.bronze, at)
        self.movie_genres = silver.silver_movie_genres(self.bronze, at)
        self.movie_companies = silver.silver_movie_companies(self.bronze, at)
        self.genres = gold.dim_genres(silver.silver_genres(genre_list(self.bronze), at), at)
        self.companies = cut_lineage(
            gold.dim_production_companies(silver.silver_production_companies(self.bronze, at), at)
        )
        self.fact = gold.fact_movies(
            self.movies, self.movie_genres, self.movie_companies, gold.dim_dates(spark),
            self.genres, self.companies, gold.budget_tiers(spark), at,
        )
        if keep_fact:
            self.fact = cut_lineage(self.fact)


_BUILT: dict[tuple[str, ...], Movies] = {}


def stored_movies(spark: SparkSession, sf_dir: str) -> Movies:
    """The tables with the fact written out, built once per session and set of input files, as marts and reports of a warehouse
    read one stored fact."""
    key = (spark.sparkContext.applicationId, spark._jsparkSession.sessionUUID(), *sorted(read(spark, sf_dir, "part").inputFiles()))
    if key not in _BUILT:
        _BUILT[key] = Movies(spark, sf_dir, keep_fact=True)
    return _BUILT[key]


_TITLE = "CASE WHEN k % 97 = 0 THEN '' ELSE '  ' || p_name || ' ' || k || ' ' END"
_ROI6 = half_up("revenue_usd - budget_usd", "budget_usd", 6)

# The raw documents of both batches, already typed.
RAW_SQL = f"""
part_rows AS (
  SELECT p_partkey AS k, p_name, p_type, p_size, p_retailprice, {_BUDGET} AS budget FROM part
),
documents_sent AS (
  SELECT *, CASE WHEN (k + 1) % 59 = 0 AND budget > 0 THEN budget
                 WHEN k % 5 = 0 THEN 0 ELSE k * 104729003 % 900000000 END AS revenue,
         'batch-1' AS batch_id, TIMESTAMP '2024-01-01' AS ingested_at
  FROM part_rows
),
raw_movies AS (
  SELECT k + 1 AS movie_id, * FROM documents_sent
  UNION ALL
  SELECT k + 1, * REPLACE (revenue + 1000000 AS revenue, 'batch-2' AS batch_id,
                           TIMESTAMP '2024-01-02' AS ingested_at)
  FROM documents_sent WHERE p_size >= 46
),
bronze AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY movie_id ORDER BY ingested_at DESC, batch_id DESC) AS rn
    FROM raw_movies) WHERE rn = 1
)"""

# Typed movies; amounts are whole numbers.
SILVER_SQL = f"""
silver_typed AS (
  SELECT movie_id, nullif(trim({_TITLE}), '') AS title, nullif(trim(p_name), '') AS original_title,
    CASE WHEN k % 3 <> 0 THEN 'Tag ' || k END AS tagline, p_type || ' of size ' || p_size AS overview,
    CASE WHEN k % 4 = 0 THEN 'https://movies.example.org/' || k END AS homepage,
    'tt' || CASE WHEN k < 10000000 THEN right('0000000' || k, 7) ELSE left(CAST(k AS VARCHAR), 7) END AS imdb_id,
    CASE WHEN k % 19 = 0 THEN 'Rumored' WHEN k % 23 <> 0 THEN 'Released' END AS status,
    CASE WHEN p_size <= 25 THEN 'en' ELSE 'fr' END AS original_language,
    CASE WHEN k % 41 <> 0 AND k % 53 <> 0
         THEN DATE '1980-01-01' + CAST(k * 37 % 16800 AS INTEGER) END AS release_date,
    nullif(budget, 0) AS budget_usd, nullif(revenue, 0) AS revenue_usd,
    nullif(CASE WHEN k % 11 = 0 THEN 0 ELSE 60 + 2 * p_size END, 0) AS runtime_minutes,
    p_retailprice / 10 AS popularity_score, (k * 31 % 101) / 10.0 AS vote_average,
    nullif(k * 13 % 500, 0) AS vote_count, k % 2 = 1 AS is_adult_content, ingested_at, batch_id, k
  FROM bronze
),
silver_movies AS (
  SELECT *, CAST(year(release_date) AS BIGINT) AS release_year,
    CAST(month(release_date) AS BIGINT) AS release_month,
    CAST(quarter(release_date) AS BIGINT) AS release_quarter,
    {season_sql("release_date")} AS release_season,
    revenue_usd - budget_usd AS profit_usd,
    CASE WHEN budget_usd > 0 AND revenue_usd IS NOT NULL
         THEN {half_up(f"round({_ROI6} * 1000000)", "10000", 2)} END AS roi_pct
  FROM silver_typed
)"""

CHILDREN_SQL = f"""
supplier_total AS (SELECT count(*) AS n FROM supplier),
genre_slots AS (
  SELECT movie_id, k, ingested_at, unnest(range(k % 4)) AS i FROM bronze WHERE k % 8 <> 0
),
movie_genres AS (
  SELECT movie_id, ({_sql_list([g[0] for g in GENRES])})[(k + 5 * i) % 19 + 1] AS genre_id,
         ({_sql_list([g[1] for g in GENRES])})[(k + 5 * i) % 19 + 1] AS genre_name_raw, ingested_at
  FROM genre_slots
),
company_slots AS (
  SELECT movie_id, k, ingested_at, unnest(range(k % 3)) AS i FROM bronze
),
company_entries AS (
  SELECT movie_id, i AS company_position, (k + i) % n AS slot, ingested_at
  FROM company_slots CROSS JOIN supplier_total
),
movie_companies AS (
  SELECT movie_id, slot + 1 AS company_id, company_position, company_position = 0 AS is_primary_company,
         CASE WHEN slot % 20 < 16 THEN ({_sql_list(STUDIOS)})[slot % 20 % 16 + 1]
              ELSE 'Studio ' || slot END AS company_name,
         nullif(upper(({_sql_list(COUNTRIES)})[slot % 6 + 1]), '') AS origin_country, ingested_at
  FROM company_entries
),
companies AS (
  SELECT * FROM (
    SELECT company_id, company_name, origin_country, ingested_at,
           row_number() OVER (PARTITION BY company_id ORDER BY ingested_at DESC, movie_id DESC, company_position) AS rn
    FROM movie_companies) WHERE rn = 1
)"""

BLOCKBUSTERS = "('ACTION', 'ADVENTURE', 'SCIENCE FICTION', 'FANTASY', 'ANIMATION')"


# Genre groups, regions and studio tiers.
DIMENSIONS_SQL = f"""
dim_genres AS (
  SELECT md5(CAST(genre_id AS VARCHAR)) AS genre_sk, genre_id, genre_name,
         CASE WHEN genre_name IN ('ACTION', 'ADVENTURE', 'THRILLER') THEN 'HIGH_OCTANE'
              WHEN genre_name IN ('DRAMA', 'ROMANCE', 'HISTORY') THEN 'NARRATIVE'
              WHEN genre_name IN ('COMEDY', 'FAMILY', 'ANIMATION') THEN 'LIGHT'
              WHEN genre_name IN ('HORROR', 'SCIENCE FICTION', 'FANTASY', 'MYSTERY', 'CRIME') THEN 'NICHE'
              WHEN genre_name IN ('DOCUMENTARY', 'MUSIC', 'WESTERN') THEN 'ARTS' ELSE 'OTHER' END AS genre_group,
         genre_name IN {BLOCKBUSTERS} AS is_blockbuster_genre
  FROM (SELECT DISTINCT genre_id, upper(genre_name_raw) AS genre_name FROM movie_genres)
),
dim_companies AS (
  SELECT md5(CAST(company_id AS VARCHAR)) AS company_sk, company_id, company_name,
         coalesce(origin_country, 'UNKNOWN') AS origin_country,
         CASE WHEN origin_country IN ('US', 'CA', 'MX') THEN 'NORTH_AMERICA'
              WHEN origin_country IN ('GB', 'FR', 'DE', 'IT', 'ES') THEN 'EUROPE'
              WHEN origin_country IN ('JP', 'CN', 'KR', 'IN', 'AU') THEN 'ASIA_PACIFIC' ELSE 'OTHER' END AS region,
         CASE WHEN company_name IN ('Universal Pictures', 'Paramount Pictures', 'Warner Bros. Pictures',
                'Columbia Pictures', 'Walt Disney Pictures', '20th Century Fox', '20th Century Studios',
                'New Line Cinema', 'Metro-Goldwyn-Mayer', 'DreamWorks Pictures') THEN 'MAJOR_STUDIO'
              WHEN company_name IN ('Lionsgate', 'Focus Features', 'Miramax') THEN 'MINI_MAJOR'
              WHEN company_name IN ('A24', 'Blumhouse Productions', 'Bad Robot') THEN 'INDIE'
              ELSE 'UNKNOWN' END AS studio_tier
  FROM companies
)"""


FACT_SQL = """
fact AS (
  SELECT md5(CAST(m.movie_id AS VARCHAR)) AS movie_sk,
    CASE WHEN release_date >= DATE '2000-01-01' AND release_date < DATE '2030-12-31'
         THEN CAST(strftime(release_date, '%Y%m%d') AS BIGINT) ELSE -1 END AS date_sk,
    coalesce(g.genre_sk, 'UNKNOWN') AS genre_sk, coalesce(c.company_sk, 'UNKNOWN') AS company_sk,
    m.movie_id, pg.genre_id AS primary_genre_id, pc.company_id AS primary_company_id, title,
    original_language, status, release_year, release_month, release_season, imdb_id, budget_usd, revenue_usd,
    profit_usd, roi_pct, runtime_minutes, popularity_score, vote_average, vote_count,
    CASE WHEN revenue_usd > budget_usd THEN 'PROFITABLE' WHEN revenue_usd = budget_usd THEN 'BREAK_EVEN'
         WHEN revenue_usd < budget_usd THEN 'LOSS' ELSE 'UNKNOWN' END AS profitability_flag,
    CASE WHEN budget_usd >= 100000000 THEN 'BLOCKBUSTER' WHEN budget_usd >= 40000000 THEN 'HIGH'
         WHEN budget_usd >= 10000000 THEN 'MID' WHEN budget_usd >= 1000000 THEN 'LOW'
         WHEN budget_usd >= 0 THEN 'MICRO' END AS budget_tier, m.ingested_at
  FROM silver_movies m
  LEFT JOIN (SELECT movie_id, min(genre_id) AS genre_id FROM movie_genres GROUP BY 1) pg USING (movie_id)
  LEFT JOIN (SELECT movie_id, company_id FROM movie_companies WHERE is_primary_company) pc USING (movie_id)
  LEFT JOIN dim_genres g ON g.genre_id = pg.genre_id
  LEFT JOIN dim_companies c ON c.company_id = pc.company_id
  WHERE status = 'Released' OR status IS NULL
)"""


def with_sql(select: str, *parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n" + select


def movie_sql(select: str) -> str:
    """A select over the raw and typed tables."""
    return with_sql(select, RAW_SQL, SILVER_SQL, CHILDREN_SQL)


def star_sql(select: str, *more: str) -> str:
    """A select over all tables up to the fact, and ``more`` common tables."""
    return with_sql(select, RAW_SQL, SILVER_SQL, CHILDREN_SQL, DIMENSIONS_SQL, FACT_SQL, *more)
