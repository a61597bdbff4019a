"""Review-shaped views over the given tables.

Each view is SQL text that Spark and the oracle engine read alike, so both sides of a
check start from the same rows. ``{name}`` marks a table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

REVIEWS_RAW = """
SELECT event_id AS pos,
  CASE user_id % 4 WHEN 0 THEN 'north' WHEN 1 THEN 'south' WHEN 2 THEN 'east' ELSE 'west' END AS source,
  concat('u', CAST(user_id AS STRING), 'd', CAST(day(ts) AS STRING),
         CASE WHEN event_id % 11 = 0 THEN '_copy' WHEN event_id % 13 = 0 THEN '_DUP' ELSE '' END) AS review_id,
  concat('Customer_', CAST(CAST(floor(user_id / 4) AS BIGINT) AS STRING)) AS customer_id,
  CASE event_id % 4
    WHEN 0 THEN concat(CAST(year(ts) AS STRING), '-', lpad(CAST(month(ts) AS STRING), 2, '0'), '-', lpad(CAST(day(ts) AS STRING), 2, '0'))
    WHEN 1 THEN concat(lpad(CAST(month(ts) AS STRING), 2, '0'), '/', lpad(CAST(day(ts) AS STRING), 2, '0'), '/', CAST(year(ts) AS STRING))
    WHEN 2 THEN concat(lpad(CAST(day(ts) AS STRING), 2, '0'), '.', lpad(CAST(month(ts) AS STRING), 2, '0'), '.', CAST(year(ts) AS STRING))
    ELSE 'not a date' END AS review_date,
  CASE event_id % 8 WHEN 0 THEN NULL WHEN 1 THEN '4 stars' WHEN 2 THEN '⭐⭐⭐' WHEN 3 THEN '⭐️⭐️'
    WHEN 4 THEN '8' WHEN 5 THEN '6' WHEN 6 THEN ' 10 ' ELSE '2' END AS rating,
  CASE event_id % 10 WHEN 0 THEN NULL WHEN 1 THEN '   ' ELSE concat(event_type, ' ', props) END AS review_text,
  CAST(CASE WHEN event_id % 5 = 0 THEN NULL ELSE CAST(value AS DECIMAL(12,2)) END AS DOUBLE) AS total_spent,
  CAST(CASE WHEN event_id % 7 = 0 THEN 0 ELSE CAST(value AS DECIMAL(12,2)) END AS DOUBLE) AS tip_amount,
  CAST(event_id % 30 AS DOUBLE) AS tip_percentage,
  CAST(event_id % 8 + 1 AS INT) AS party_size,
  CAST(NULL AS STRING) AS age_range,
  CASE WHEN event_id % 3 = 0 THEN 'f' ELSE 'm' END AS gender,
  event_type AS ethnicity
FROM {events}
"""

# One restaurant per source, and one that no source fills.
DIMENSION_RAW = """
SELECT CASE r_regionkey WHEN 0 THEN 'North' WHEN 1 THEN 'South' WHEN 2 THEN 'East' WHEN 3 THEN 'West' ELSE 'Central' END AS location,
  concat(r_name, ' House') AS restaurant_name,
  r_name AS original_city,
  concat(CAST(min(n_nationkey) AS STRING), ' ', min(n_name), ' Street') AS address,
  concat(r_name, ', ', min(n_name), ' ,', max(n_name), ', American (New)') AS categories,
  CAST(4.0 AS DOUBLE) AS avg_stars,
  count(*) AS total_reviews
FROM {nation} JOIN {region} ON n_regionkey = r_regionkey
GROUP BY r_regionkey, r_name
"""

# One restaurant per nation: names that nest (NATION_1 in NATION_12) and a repeated name.
NATION_DIMENSION = """
SELECT n_nationkey AS pos, n_name AS location,
  CASE WHEN n_nationkey = 24 THEN ' nation_3 house ' ELSE concat(n_name, ' House') END AS restaurant_name,
  concat(r_name, ', ', n_name) AS categories
FROM {nation} JOIN {region} ON n_regionkey = r_regionkey
"""

MAPPING_CONFIG = """
SELECT min(event_id) AS pos,
  CASE WHEN user_id % 3 = 0 THEN upper(event_type) ELSE event_type END AS source_dataset,
  concat('col_', CAST(user_id % 5 AS STRING)) AS input_column,
  concat('target_', CAST(max(user_id) % 7 AS STRING)) AS target_column,
  CAST(CASE WHEN event_type IN ('view', 'click') AND user_id % 5 = 2 THEN max(user_id) % 4 + 1.5 END AS DOUBLE) AS rating_divisor
FROM {events}
GROUP BY event_type, user_id % 3, user_id % 5
"""

KEYS = """
SELECT doc_id,
  concat(CASE WHEN doc_id % 17 = 0 THEN 'archive/' ELSE 'raw/' END, lang, '%20files/',
    CASE WHEN doc_id % 13 = 0 THEN 'other' ELSE upper(source) END,
    CASE doc_id % 19 WHEN 0 THEN '_restaurant_info' WHEN 1 THEN '+Reference' ELSE '_reviews' END,
    CASE WHEN doc_id % 4 = 0 THEN '.txt' ELSE '.csv' END) AS key
FROM {documents}
"""

# A source of its own for every document: names nest (src1_1 in src1_10).
MANY_KEYS = """
SELECT doc_id, concat(source, '_', CAST(doc_id AS STRING)) AS source,
  concat('raw/', upper(source), '_', CAST(doc_id AS STRING), '_reviews.csv') AS key
FROM {documents}
"""

INDEX = """
SELECT CAST(vec_id AS STRING) AS review_id, concat('r', CAST(label AS STRING)) AS restaurant_id,
  CAST(vec_id % 5 + 1 AS FLOAT) AS rating, embedding
FROM {embeddings}
"""

QUESTIONS_TEXT = """
SELECT c_custkey AS q_id,
  CASE WHEN c_custkey % 29 = 0 THEN '  '
    WHEN c_custkey % 3 = 0 THEN concat(' What do guests say about ', a.n_name, '?')
    WHEN c_custkey % 3 = 1 THEN concat('How does ', a.n_name, ' House compare with ', b.n_name, ' on waiting?')
    ELSE 'Where is the service friendly?' END AS question,
  CASE WHEN c_custkey % 7 = 0 THEN 'NATION_9' WHEN c_custkey % 7 = 1 THEN '' END AS payload_id,
  CASE WHEN c_custkey % 5 = 0 THEN 'Nation_2,nation_4' WHEN c_custkey % 5 = 1 THEN '' WHEN c_custkey % 5 = 2 THEN 'elsewhere' END AS payload_list
FROM {customer} JOIN {nation} a ON c_nationkey = a.n_nationkey
JOIN {nation} b ON b.n_nationkey = CAST(c_custkey % 25 AS INT)
"""

DOCS = """
SELECT doc_id AS pos, CAST(CASE WHEN doc_id % 37 = 0 THEN NULL WHEN doc_id % 41 = 0 THEN '' ELSE CAST(doc_id - doc_id % 2 * (doc_id % 3) AS STRING) END AS STRING) AS review_id,
  source AS restaurant_id, CASE doc_id % 6 WHEN 0 THEN 'nan' WHEN 1 THEN '' WHEN 2 THEN '4d' ELSE CAST(doc_id % 5 + 1 AS STRING) END AS rating,
  CASE WHEN doc_id % 7 = 0 THEN '2024-03-15' WHEN doc_id % 7 = 1 THEN '' WHEN doc_id % 7 = 2 THEN '2024-02-31' END AS review_date,
  CASE WHEN doc_id % 23 = 0 THEN ' \n ' ELSE text END AS review_text
FROM {documents}
"""

INDEXED_IDS = "SELECT CAST(doc_id AS STRING) AS review_id FROM {labels}"

# An answer per assistant turn; the turn before it supplies the expected keywords.
ANSWERS = """
SELECT a.conv_id * 1000 + a.turn AS id,
  CASE a.turn % 3 WHEN 0 THEN 'ratings' WHEN 1 THEN 'Calculations' ELSE 'sentiment' END AS category,
  CASE WHEN a.conv_id % 11 = 0 THEN '' WHEN a.conv_id % 7 = 0 THEN concat('Quantitative questions are NOT authorized. ', a.text) ELSE a.text END AS answer,
  u.text AS query,
  CAST(length(a.text) AS DOUBLE) / 100 AS latency
FROM {conversations} a JOIN {conversations} u ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
WHERE a.role = 'assistant' AND u.role = 'user'
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """Run a view's SQL with its ``{name}`` marks bound to the Parquet tables."""
    names = {w.split("}")[0] for w in sql.split("{")[1:]}
    return spark.sql(sql, **{n: table(spark, sf_dir, n) for n in names})


def oracle_text(sql: str) -> str:
    """The same view as a subquery over plain table names."""
    return sql.replace("{", "").replace("}", "").strip()
