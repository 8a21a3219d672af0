"""Queries of the two general training-data operators over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewflow.operators import drift, instants
from reviewflow.storage import shared_dir


def _read(spark: SparkSession, d: str, *names: str) -> list[DataFrame]:
    return [spark.read.parquet(f"{d}/{n}.parquet") for n in names]


def p3_instants(spark: SparkSession, d: str) -> DataFrame:
    """The operator's whole result: every review row with its instant or null. The dictionary persists between runs."""
    reviews, files = _read(spark, d, "reviews", "export_files")
    rows = reviews.select("review_id", "file_id", F.col("评论日期").alias("raw")).join(files.select("file_id", "time_zone", "locale"), "file_id", "left")
    return instants.normalise_instants(rows, "review_id", "raw", "time_zone", "locale", path=f"{shared_dir(spark)}/instant-dictionary")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    reviews, files = _read(spark, d, "reviews", "export_files")
    # A value already in the exact form is no case, so it need not be parsed here.
    open_rows = reviews.select("review_id", "file_id", F.col("评论日期").alias("raw")).where(~F.col("raw").rlike(instants.EXACT))
    rows = open_rows.join(files.select("file_id", "time_zone", "locale"), "file_id", "left")
    return instants.normalise_instants(rows, "review_id", "raw", "time_zone", "locale").where("utc_time IS NOT NULL")


def _drift_inputs(spark: SparkSession, d: str) -> list[DataFrame]:
    return _read(spark, d, "raw_exports", "export_files", "header_standardizer", "platform_preprocessing")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return drift.schema_changes(*_drift_inputs(spark, d))


def p6_table(spark: SparkSession, d: str) -> DataFrame:
    return drift.consistent_table(*_drift_inputs(spark, d))


def p6_cast_report(spark: SparkSession, d: str) -> DataFrame:
    return drift.cast_report(*_drift_inputs(spark, d))


QUERIES = {f.__name__: f for f in (p3_found, p3_instants, p6_found, p6_table, p6_cast_report)}


#: A header without white space, for DuckDB.
_BARE = r"regexp_replace({c}, '[\x09-\x0d\x1c-\x20\x{{85}}\x{{a0}}\x{{1680}}\x{{2000}}-\x{{200b}}\x{{2028}}\x{{2029}}\x{{202f}}\x{{205f}}\x{{3000}}\x{{feff}}]+', '', 'g')"

P6_FOUND = f"""
WITH kv AS (SELECT file_id, k, json_type(json_extract(payload, '$."' || k || '"')) AS ty FROM (SELECT file_id, payload, unnest(json_keys(payload)) AS k FROM raw_exports WHERE json_valid(payload))),
c AS (SELECT file_id, k, CASE ty WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'ARRAY' THEN 'array' WHEN 'OBJECT' THEN 'object' WHEN 'NULL' THEN NULL ELSE 'number' END AS t, count(*) AS n FROM kv GROUP BY ALL),
h AS (SELECT file_id, k, arg_max(t, (n, t)) FILTER (t IS NOT NULL) AS t FROM c GROUP BY 1, 2),
f AS (SELECT file_id, namespace, lag(file_id) OVER (PARTITION BY feed_id ORDER BY exported_at, file_id) AS prev FROM export_files WHERE feed_id IS NOT NULL AND file_id IN (SELECT file_id FROM h)),
new AS (SELECT f.file_id, namespace, k, t FROM f JOIN h ON h.file_id = f.file_id WHERE prev IS NOT NULL),
old AS (SELECT f.file_id, namespace, k, t FROM f JOIN h ON h.file_id = f.prev),
moved AS (SELECT file_id, namespace, k, 'new' AS side FROM new WHERE (file_id, k) NOT IN (SELECT file_id, k FROM old)
 UNION ALL SELECT file_id, namespace, k, 'old' FROM old WHERE (file_id, k) NOT IN (SELECT file_id, k FROM new)),
plat AS (SELECT namespace, {_BARE.format(c="unnest(header_signature)")} AS b, unnest(mapped_headers) AS o FROM platform_preprocessing),
plat1 AS (SELECT namespace, b, min(o) AS o FROM plat GROUP BY ALL),
al AS (SELECT header AS o, {_BARE.format(c="unnest(aliases)")} AS b FROM header_standardizer), al1 AS (SELECT b, min(o) AS o FROM al GROUP BY b),
g AS (SELECT m.*, CASE WHEN m.namespace IN (SELECT namespace FROM platform_preprocessing) THEN p.o ELSE a.o END AS o FROM moved m
 LEFT JOIN plat1 p ON p.namespace = m.namespace AND p.b = {_BARE.format(c="m.k")} LEFT JOIN al1 a ON a.b = {_BARE.format(c="m.k")}),
r AS (SELECT *, coalesce('f:' || o, 'h:' || k) AS grp, row_number() OVER (PARTITION BY file_id, coalesce('f:' || o, 'h:' || k), side ORDER BY encode(k)) AS i FROM g),
pairs AS (SELECT file_id, max(k) FILTER (side = 'old') AS a, max(k) FILTER (side = 'new') AS b FROM r GROUP BY file_id, grp, i)
SELECT file_id, CASE WHEN a IS NULL THEN 'added' WHEN b IS NULL THEN 'removed' ELSE 'renamed' END AS change, coalesce(a, '') AS old_field, coalesce(b, '') AS new_field FROM pairs
UNION ALL SELECT new.file_id, 'retyped', new.k, new.k FROM new JOIN old ON old.file_id = new.file_id AND old.k = new.k WHERE new.t <> old.t
"""

#: First delivery of each record, its values as text and JSON type, and the output field of each header.
_VALUES = f"""
once AS (SELECT * FROM raw_exports QUALIFY row_number() OVER (PARTITION BY file_id, row_no ORDER BY received_at, record_id) = 1),
kv AS (SELECT file_id, record_id, payload, unnest(json_keys(payload)) AS header FROM once WHERE json_valid(payload)),
j AS (SELECT file_id, record_id, header, json_extract(payload, '$."' || header || '"') AS v FROM kv),
t AS (SELECT file_id, record_id, header, json_type(v) AS ty, CASE WHEN json_type(v) = 'NULL' THEN NULL WHEN json_type(v) = 'VARCHAR' THEN v ->> '$' ELSE CAST(v AS VARCHAR) END AS text FROM j),
plat AS (SELECT namespace, {_BARE.format(c="unnest(header_signature)")} AS b, unnest(mapped_headers) AS o FROM platform_preprocessing),
plat1 AS (SELECT namespace, b, min(o) AS o FROM plat GROUP BY ALL),
al AS (SELECT header AS o, {_BARE.format(c="unnest(aliases)")} AS b FROM header_standardizer), al1 AS (SELECT b, min(o) AS o FROM al GROUP BY b),
m AS (SELECT t.file_id, t.record_id, t.header, CASE WHEN f.namespace IN (SELECT namespace FROM platform_preprocessing) THEN p.o ELSE a.o END AS field, t.text,
 CASE ty WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'ARRAY' THEN 'array' WHEN 'OBJECT' THEN 'object' WHEN 'NULL' THEN NULL ELSE 'number' END AS json_type
 FROM t LEFT JOIN export_files f USING (file_id) LEFT JOIN plat1 p ON p.namespace = f.namespace AND p.b = {_BARE.format(c="t.header")} LEFT JOIN al1 a ON a.b = {_BARE.format(c="t.header")})"""

P6_CAST_REPORT = f"""
WITH {_VALUES}
SELECT file_id, header, field, json_type, count(*) AS n_values,
 count(*) FILTER ((field = '电商平台评分' AND try_cast(replace(trim(text, ' '), ',', '') AS DOUBLE) IS NULL)
 OR (field IN ('点赞数', '子评论数/追评数') AND try_cast(replace(trim(text, ' '), ',', '') AS DECIMAL(38, 0)) IS NULL)) AS n_failed
FROM m WHERE text IS NOT NULL GROUP BY ALL
"""

ORACLES = {"p6_found": P6_FOUND, "p6_cast_report": P6_CAST_REPORT}
