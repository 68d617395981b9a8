"""What the test tables stand for: lineitem as scored candidates, events as timed
segments, embeddings as faces, documents as clips with content.

Each binding is one SELECT in the SQL that Spark and DuckDB share; {us} is the
microseconds of events.ts, which each spells in its own way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")
SPARK_US, DUCK_US = "timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)", "epoch_us(ts)"

CANDIDATES = """
SELECT CAST(l_suppkey AS STRING) AS speaker_id,
       concat(l_returnflag, l_linestatus) AS video_id,
       (((CAST(l_orderkey AS BIGINT) * 10 + l_linenumber) * 100000 + l_partkey) * 1000 + l_suppkey) * 100 + CAST(l_quantity AS BIGINT) AS row_ord,
       CASE WHEN l_linenumber = 7 THEN 'Relaxed' ELSE 'standard' END AS candidate_profile,
       CASE WHEN l_orderkey % 13 = 0 THEN NULL ELSE '1' END AS pipeline_version,
       0.5 + l_quantity / 100 AS face_conf,
       0.02 + l_tax * 2 AS face_margin,
       0.6 + l_discount * 4 AS face_track_consistency,
       1 - l_discount * 5 AS quality_score,
       2 + l_tax * 100 AS syncnet_confidence,
       CAST(CAST(floor(l_extendedprice) AS BIGINT) % 1000 AS DOUBLE) / 1000 AS active_confidence,
       CASE WHEN l_linenumber = 5 AND l_partkey % 3 = 0 THEN CAST('NaN' AS DOUBLE) ELSE l_quantity * 0.6 END AS snr_db,
       CAST(l_linenumber AS DOUBLE) / 10 + 0.3 AS vad_ratio,
       CAST(l_linenumber AS DOUBLE) / 1000 AS rms,
       l_discount / 3 AS clipping_ratio,
       l_linenumber - 4 AS syncnet_offset_frames,
       CASE WHEN l_partkey % 5 = 0 THEN 0 ELSE 1 END AS syncnet_verified,
       CASE WHEN l_partkey % 7 = 0 THEN 0 ELSE 1 END AS syncnet_unambiguous,
       CAST(l_partkey % 600 AS DOUBLE) AS start,
       CAST(l_partkey % 600 AS DOUBLE) + 2 + CAST(l_linenumber AS DOUBLE) / 4 AS `end`,
       2 + CAST(l_linenumber AS DOUBLE) / 4 AS duration,
       concat('clip/', CAST(l_suppkey AS STRING), '/', CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING), '-', CAST(l_partkey AS STRING), '-', CAST(CAST(l_quantity AS BIGINT) AS STRING)) AS candidate_path,
       CASE WHEN l_linenumber = 6 THEN '' ELSE sha1(concat(CAST(l_suppkey AS STRING), ':', CAST(l_partkey % 700 AS STRING))) END AS sha1,
       l_orderkey % 11 <> 0 AS file_exists
FROM {lineitem}"""

SEGMENTS = """
SELECT CAST(user_id AS STRING) AS speaker_id, event_type AS video_id, CAST(event_id AS BIGINT) AS row_ord,
       CAST(floor(CAST({us} AS DOUBLE) / 1000000) AS DOUBLE) AS start,
       CAST(floor(CAST({us} AS DOUBLE) / 1000000) + floor(value * 600) AS DOUBLE) AS `end`,
       value AS score
FROM {events}"""

CLIPS = """
SELECT CAST(user_id AS STRING) AS speaker_id, event_type AS video_id,
       CASE WHEN user_id % 2 = 0 THEN 'f' ELSE 'm' END AS gender,
       concat(CAST(user_id AS STRING), '/', event_type, '/', lpad(CAST(event_id AS STRING), 7, '0'), '.wav') AS path
FROM {events}"""


def bound(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    used = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if f"{{{t}}}" in text}
    return spark.sql(text.replace("{us}", SPARK_US), **used)


def duck(text: str) -> str:
    """The binding as DuckDB reads it."""
    for t in TABLES:
        text = text.replace(f"{{{t}}}", t)
    return text.replace("{us}", DUCK_US).replace("`", '"')
