"""DuckDB SQL for every registered query (the correctness oracle).

Written against the pre-registered views of the driver's tables.  The rules
are spelled out in plain SQL so the oracle shares no code path with Spark:

* numbers: the same readable-number pattern and a finiteness test;
* per-cell means: ``round(cast(avg(x) as decimal(18,10)), 2)`` - DuckDB's
  double rounding differs from Spark's HALF_UP on decimal text otherwise;
* view means: exact integer cents, ``(2*C + N) // (2*N)`` (HALF_UP);
* sums: cast to BIGINT (DuckDB sums integers as HUGEINT).
"""

from __future__ import annotations

# Fixed values, stated here again so that nothing of the code under test is used.
AGE_BANDS = ("Jovem", "Adulto", "Madura", "Sênior")
SENTIMENTS = ("Positivo", "Neutro", "Negativo")
_J, _A, _M, _S = AGE_BANDS
_POS, _NEU, _NEG = SENTIMENTS
# Full-width digits are the only other digits in the derived data.
_WIDE, _PLAIN = "\uff10\uff11\uff12\uff13\uff14\uff15\uff16\uff17\uff18\uff19", "0123456789"


def num(x: str) -> str:
    """A decimal or exponent number between blanks, with single underscores between digits."""
    digits = "[0-9](_?[0-9])*"
    pattern = f"^[ \\t]*[+-]?({digits}([.]({digits})?)?|[.]{digits})([eE][+-]?{digits})?[ \\t]*$"
    plain = f"translate({x}, '{_WIDE}', '{_PLAIN}')"
    value = f"try_cast(replace({plain}, '_', '') AS DOUBLE)"
    return f"(CASE WHEN regexp_matches({plain}, '{pattern}') AND isfinite({value}) THEN {value} END)"


def age_band(x: str) -> str:
    n = num(x)
    return (
        f"(CASE WHEN {n} >= 18 AND {n} < 30 THEN '{_J}' WHEN {n} >= 30 AND {n} < 45 THEN '{_A}' "
        f"WHEN {n} >= 45 AND {n} < 60 THEN '{_M}' WHEN {n} >= 60 THEN '{_S}' END)"
    )


def sentiment(r: str, c: str) -> str:
    nr, nc = num(r), num(c)
    return (
        f"(CASE WHEN {nr} >= 4 AND {nc} >= 1 AND {nc} < 2 THEN '{_POS}' "
        f"WHEN {nr} >= 3 AND {nr} < 4 THEN '{_NEU}' ELSE '{_NEG}' END)"
    )


def lenient_int(x: str) -> str:
    n = num(x)
    return f"CAST(trunc({n}) AS DECIMAL(38,0))"


def _reviews_cte(table: str, rid: str, age_base: str, text: str, rating_src: str, dept: str, day: str) -> str:
    return f"""
reviews AS (
  SELECT
    CAST({rid} AS VARCHAR) AS clothing_id,
    CASE WHEN {rid} % 97 = 0 THEN 'abc'
         WHEN {rid} % 89 = 0 THEN NULL
         WHEN {rid} % 7 = 0 THEN CAST(10 + {age_base} % 60 AS VARCHAR) || '.9'
         WHEN {rid} % 71 = 0 THEN '4.5e1' WHEN {rid} % 61 = 0 THEN '3_0' WHEN {rid} % 59 = 0 THEN '\uff12\uff15'
         ELSE CAST(10 + {age_base} % 60 AS VARCHAR) END AS age,
    CASE WHEN {rid} % 10 = 0 THEN '' WHEN {rid} % 10 = 5 THEN '   ' ELSE {text} END AS review_text,
    CASE WHEN {rid} % 43 = 0 THEN '?' WHEN {rid} % 41 = 0 THEN '4.5' WHEN {rid} % 37 = 0 THEN '0' WHEN {rid} % 31 = 0 THEN '3e0'
         ELSE CAST(1 + CAST(floor({rating_src}) AS INTEGER) % 5 AS VARCHAR) END AS rating,
    CASE WHEN {rid} % 47 = 0 THEN 'yes' WHEN {rid} % 29 = 0 THEN '1.0' WHEN {rid} % 23 = 0 THEN '2'
         WHEN {rid} % 3 = 0 THEN '0' ELSE '1' END AS recommended_ind,
    CASE WHEN {rid} % 53 = 0 THEN NULL WHEN {rid} % 67 = 0 THEN '' ELSE {dept} END AS department_name,
    CAST({day} AS DATE) AS dt
  FROM {table}
)"""


# Reviews derived from ``events`` (snake_case names, as after P1).
REVIEWS_CTE = _reviews_cte("events", "event_id", "user_id", "props", "value", "event_type", "ts")
# Reviews derived from ``lineitem``.
LINEITEM_REVIEWS_CTE = _reviews_cte(
    "lineitem",
    "(l_orderkey * 8 + l_linenumber)",
    "l_partkey",
    "'lineitem review'",
    "l_quantity",
    "l_returnflag || l_linestatus",
    "l_shipdate",
)

TRUSTED_CTE = f"""
trusted AS (
  SELECT *, {age_band('age')} AS age_band
  FROM reviews
  WHERE review_text IS NOT NULL AND length(trim(review_text, ' ')) > 0
)"""

PRODUCT_CTE = f"""
product AS (
  SELECT age_band, department_name, sentiment,
         CAST(count(*) AS INTEGER) AS review_count,
         CAST(round(CAST(avg(rnum) AS DECIMAL(18,10)), 2) AS DOUBLE) AS avg_rating,
         dt
  FROM (SELECT dt, age_band, department_name, {sentiment('rating', 'recommended_ind')} AS sentiment,
               try_cast(rating AS DOUBLE) AS rnum
        FROM trusted
        WHERE age_band IS NOT NULL AND department_name IS NOT NULL)
  GROUP BY dt, age_band, department_name, sentiment
)"""

DAYS_CTE = """
days AS (SELECT DISTINCT CAST(ts AS DATE) AS dt FROM events)"""


def with_product(body: str) -> str:
    return f"WITH {REVIEWS_CTE},{TRUSTED_CTE},{PRODUCT_CTE}\n{body}"


# The lake's raw layer is CSV, where an empty cell reads as null: such departments drop out.
STORED_CTE = """
stored AS (SELECT * FROM product WHERE department_name <> '')"""
# The flawed table: its first day holds every row again without a band, and again without a sentiment.
FLAWED_CTE = """
flawed AS (
  SELECT * FROM stored
  UNION ALL
  SELECT NULL, department_name, sentiment, review_count, avg_rating, dt FROM stored WHERE dt = (SELECT min(CAST(ts AS DATE)) FROM events)
  UNION ALL
  SELECT age_band, department_name, NULL, review_count, avg_rating, dt FROM stored WHERE dt = (SELECT min(CAST(ts AS DATE)) FROM events)
)"""


def with_stored(body: str) -> str:
    return f"WITH {REVIEWS_CTE},{TRUSTED_CTE},{PRODUCT_CTE},{STORED_CTE},{FLAWED_CTE}\n{body}"


def _mean_of_means() -> str:
    cents = "CAST(round(avg_rating * 100) AS BIGINT)"
    return (
        f"CAST((2 * sum({cents}) + count(avg_rating)) // (2 * count(avg_rating)) AS DOUBLE) / 100.0"
    )


PRODUCT_COLS = "age_band, department_name, sentiment, review_count, avg_rating, dt"

_first_day = "(SELECT min(CAST(ts AS DATE)) FROM events)"
_n_days = "(SELECT count(DISTINCT CAST(ts AS DATE)) FROM events)"


def _checks_sql(source: str = "product", skipped: int = 0) -> str:
    """The six checks; ``skipped`` first days are neither expected nor read."""
    exp_bands = ",".join(sorted(AGE_BANDS))
    exp_sents = ",".join(sorted(SENTIMENTS))
    body = with_product("") if source == "product" else with_stored("")
    return body + (
        f""",
stats AS (
  SELECT count(DISTINCT dt) AS n_dt,
         list_sort(list(DISTINCT age_band) FILTER (WHERE age_band IS NOT NULL)) AS bands,
         list_sort(list(DISTINCT sentiment) FILTER (WHERE sentiment IS NOT NULL)) AS sents,
         count(*) FILTER (WHERE age_band IS NULL) AS null_bands,
         count(*) FILTER (WHERE sentiment IS NULL) AS null_sents,
         min(dt) AS min_dt, max(dt) AS max_dt,
         {_n_days} - {skipped} AS n_exp,
         CAST({_first_day} + {skipped} AS DATE) AS min_exp
  FROM {source} WHERE dt >= {_first_day} + {skipped}
),
s AS (SELECT *, CAST(min_exp + CAST(n_exp - 1 AS INTEGER) AS DATE) AS max_exp,
             coalesce(array_to_string(bands, ','), '') AS bands_txt,
             coalesce(array_to_string(sents, ','), '') AS sents_txt,
             CASE WHEN coalesce(len(bands), 0) = 0 THEN '[]'
                  ELSE '[''' || array_to_string(bands, ''', ''') || ''']' END AS bands_repr,
             CASE WHEN coalesce(len(sents), 0) = 0 THEN '[]'
                  ELSE '[''' || array_to_string(sents, ''', ''') || ''']' END AS sents_repr FROM stats)
SELECT 1 AS check_id, 'COUNT DISTINCT dt' AS name,
       CASE WHEN n_dt = n_exp THEN 'PASS' ELSE 'FAIL' END AS status,
       CAST(n_exp AS VARCHAR) AS expected, CAST(n_dt AS VARCHAR) AS actual,
       'count=' || CAST(n_dt AS VARCHAR) AS detail FROM s
UNION ALL
SELECT 2, 'DISTINCT age_band', CASE WHEN bands_txt = '{exp_bands}' THEN 'PASS' ELSE 'FAIL' END,
       '{exp_bands}', bands_txt, 'values=' || bands_repr FROM s
UNION ALL
SELECT 3, 'DISTINCT sentiment', CASE WHEN sents_txt = '{exp_sents}' THEN 'PASS' ELSE 'FAIL' END,
       '{exp_sents}', sents_txt, 'values=' || sents_repr FROM s
UNION ALL
SELECT 4, 'age_band IS NULL', CASE WHEN null_bands = 0 THEN 'PASS' ELSE 'FAIL' END,
       '0', CAST(null_bands AS VARCHAR), 'count=' || CAST(null_bands AS VARCHAR) FROM s
UNION ALL
SELECT 5, 'sentiment IS NULL', CASE WHEN null_sents = 0 THEN 'PASS' ELSE 'FAIL' END,
       '0', CAST(null_sents AS VARCHAR), 'count=' || CAST(null_sents AS VARCHAR) FROM s
UNION ALL
SELECT 6, 'MIN/MAX dt',
       CASE WHEN coalesce(min_dt = min_exp AND max_dt = max_exp, false) THEN 'PASS' ELSE 'FAIL' END,
       CAST(min_exp AS VARCHAR) || '..' || CAST(max_exp AS VARCHAR),
       concat_ws('..', CAST(min_dt AS VARCHAR), CAST(max_dt AS VARCHAR)),
       'min=' || coalesce(CAST(min_dt AS VARCHAR), 'None') || ' max=' || coalesce(CAST(max_dt AS VARCHAR), 'None')
FROM s"""
    )


def _batches_sql(size: int = 100, start: str = "2024-01-01") -> str:
    return f"""
batches AS (
  SELECT d.*, r.row_index, r.row_index // {size} AS batch_index,
         CAST(DATE '{start}' + CAST(r.row_index // {size} AS INTEGER) AS DATE) AS dt,
         printf('batch_%03d', r.row_index // {size} + 1) AS batch
  FROM documents d
  JOIN (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS row_index FROM documents) r
    USING (doc_id)
)"""


def _report_json_sql(target: str = "customer_sentiment.customer_sentiment_by_age") -> str:
    """The report's checks as written to JSON and read back with text values."""
    taken = {
        1: "count(DISTINCT dt)", 2: "array_sort(collect_set(age_band))", 3: "array_sort(collect_set(sentiment))",
        4: "count_if(age_band IS NULL)", 5: "count_if(sentiment IS NULL)", 6: "min(dt), max(dt)",
    }
    sql = " ".join(f"WHEN {cid} THEN 'SELECT {text} FROM {target}'" for cid, text in taken.items())

    def as_json(x: str) -> str:
        return (
            f"CASE WHEN {x} IS NULL THEN NULL "
            f"WHEN check_id IN (2, 3) THEN CASE WHEN {x} = '' THEN '[]' "
            f"ELSE '[\"' || replace({x}, ',', '\",\"') || '\"]' END "
            f"WHEN check_id = 6 THEN CASE WHEN {x} = '' THEN '{{\"min\":null,\"max\":null}}' "
            f"ELSE '{{\"min\":\"' || split_part({x}, '..', 1) || '\",\"max\":\"' "
            f"|| split_part({x}, '..', 2) || '\"}}' END "
            f"ELSE {x} END"
        )

    return (
        f"WITH checks AS ({_checks_sql()})\n"
        f"SELECT check_id, name, status, {as_json('expected')} AS expected, {as_json('actual')} AS actual, "
        f"CASE check_id {sql} END AS sql, detail FROM checks"
    )


def queries_sql() -> dict[str, str]:
    trusted_cols = (
        "clothing_id, age, review_text, rating, recommended_ind, department_name, dt, age_band"
    )
    q: dict[str, str] = {}
    q["clean_reviews"] = f"WITH {REVIEWS_CTE},{TRUSTED_CTE}\nSELECT {trusted_cols} FROM trusted"
    q["age_band"] = f"WITH {REVIEWS_CTE}\nSELECT clothing_id, age, {age_band('age')} AS age_band FROM reviews"
    q["sentiment"] = (
        f"WITH {REVIEWS_CTE}\nSELECT clothing_id, rating, recommended_ind, "
        f"{sentiment('rating', 'recommended_ind')} AS sentiment FROM reviews"
    )
    q["lenient_number"] = (
        f"WITH {REVIEWS_CTE}\nSELECT clothing_id, age, {num('age')} AS age_number, "
        f"{lenient_int('age')} AS age_int FROM reviews"
    )
    q["sql_functions"] = (
        f"WITH {REVIEWS_CTE}\nSELECT clothing_id, {age_band('age')} AS age_band, "
        f"{sentiment('rating', 'recommended_ind')} AS sentiment FROM reviews"
    )
    q["daily_product"] = with_product(f"SELECT {PRODUCT_COLS} FROM product")
    q["lineitem_product"] = (
        f"WITH {LINEITEM_REVIEWS_CTE},{TRUSTED_CTE},{PRODUCT_CTE}\nSELECT {PRODUCT_COLS} FROM product"
    )
    q["product_for_day"] = with_product(
        "SELECT age_band, department_name, sentiment, review_count, avg_rating FROM product "
        "WHERE dt = DATE '2024-01-15'"
    )
    q["product_from_day"] = with_product(f"SELECT {PRODUCT_COLS} FROM product WHERE dt >= DATE '2024-01-20'")
    q["vw_sentiment_by_age"] = with_product(
        f"SELECT age_band, sentiment, CAST(sum(review_count) AS BIGINT) AS total_reviews, "
        f"{_mean_of_means()} AS media_nota FROM product GROUP BY age_band, sentiment "
        f"ORDER BY age_band, sentiment"
    )
    q["vw_sentiment_by_dept"] = with_product(
        f"SELECT department_name, sentiment, CAST(sum(review_count) AS BIGINT) AS total_reviews, "
        f"{_mean_of_means()} AS media_nota FROM product GROUP BY department_name, sentiment "
        f"ORDER BY department_name, sentiment"
    )
    q["vw_daily_trend"] = with_product(
        "SELECT dt, sentiment, CAST(sum(review_count) AS BIGINT) AS total_reviews FROM product "
        "GROUP BY dt, sentiment ORDER BY dt, sentiment"
    )
    q["check_distinct_dt"] = with_stored("SELECT count(DISTINCT dt) AS n_dt FROM flawed")
    q["check_age_bands"] = with_stored(
        "SELECT DISTINCT age_band FROM flawed WHERE age_band IS NOT NULL ORDER BY age_band"
    )
    q["check_sentiments"] = with_stored(
        "SELECT DISTINCT sentiment FROM flawed WHERE sentiment IS NOT NULL ORDER BY sentiment"
    )
    q["check_null_age_band"] = with_stored("SELECT count(*) AS null_count FROM flawed WHERE age_band IS NULL")
    q["check_null_sentiment"] = with_stored("SELECT count(*) AS null_count FROM flawed WHERE sentiment IS NULL")
    q["check_dt_range"] = with_stored("SELECT min(dt) AS min_dt, max(dt) AS max_dt FROM flawed")
    q["quality_report"] = _checks_sql()
    q["quality_summary"] = (
        f"WITH checks AS ({_checks_sql()})\n"
        "SELECT count(*) FILTER (WHERE status = 'PASS') AS pass_count, "
        "count(*) FILTER (WHERE status <> 'PASS') AS fail_count, "
        "CASE WHEN count(*) FILTER (WHERE status <> 'PASS') = 0 THEN 'PASS' ELSE 'FAIL' END AS overall "
        "FROM checks"
    )
    q["quality_report_stored"] = _checks_sql("flawed")
    q["vw_sentiment_by_age_large"] = with_product(
        "SELECT age_band, sentiment, CAST(sum(review_count) AS BIGINT) AS total_reviews, "
        "round(avg(review_count * 2e14), 2) AS media_nota FROM product GROUP BY age_band, sentiment ORDER BY age_band, sentiment"
    )
    q["quality_report_states"] = _checks_sql(skipped=1)
    for view, label in (("vw_sentiment_by_age", "age_band"), ("vw_sentiment_by_dept", "department_name")):
        q[f"{view}_kept"] = with_product(
            f"SELECT {label}, sentiment, CAST(sum(review_count) AS BIGINT) AS total_reviews, {_mean_of_means()} AS media_nota "
            f"FROM product WHERE dt <> {_first_day} GROUP BY {label}, sentiment"
        )
    q["quality_report_json"] = _report_json_sql()
    q["partition_counts"] = (
        f"WITH {REVIEWS_CTE},{TRUSTED_CTE},{PRODUCT_CTE},{DAYS_CTE}\n"
        "SELECT d.dt, coalesce(c.row_count, 0) AS row_count FROM days d "
        "LEFT JOIN (SELECT dt, count(*) AS row_count FROM product GROUP BY dt) c USING (dt)"
    )
    q["table_count"] = with_product("SELECT count(*) AS row_count FROM product")
    batches = _batches_sql()
    q["assign_batches"] = (
        f"WITH {batches}\nSELECT doc_id, text, lang, source, n_chars, row_index, batch_index, dt, batch FROM batches"
    )
    # W1 with a hot lead value: each line number holds up to a quarter of lineitem.
    q["assign_batches_lineitem"] = (
        "SELECT l_orderkey, l_linenumber, row_index, row_index // 100 AS batch_index, "
        "CAST(DATE '2024-01-01' + CAST(row_index // 100 AS INTEGER) AS DATE) AS dt, "
        "printf('batch_%03d', row_index // 100 + 1) AS batch FROM ("
        "SELECT l_orderkey, l_linenumber, row_number() OVER (ORDER BY l_linenumber, l_orderkey) - 1 AS row_index "
        "FROM lineitem)"
    )
    q["batch_summary"] = (
        f"WITH {batches}\nSELECT dt, batch, batch_index, count(*) AS n_rows, min(doc_id) AS first_key, "
        "max(doc_id) AS last_key FROM batches GROUP BY dt, batch, batch_index ORDER BY batch_index"
    )
    # every third batch is stored, the second one torn
    q["ingest_missing_batches"] = f"WITH {batches}\nSELECT DISTINCT dt, batch FROM batches WHERE batch_index % 3 <> 0"
    q["ingest_csv_documents"] = (
        f"WITH {batches}\nSELECT CAST(doc_id AS VARCHAR) AS doc_id, nullif(text, '') AS text, lang, source, CAST(n_chars AS VARCHAR) AS n_chars, dt, batch FROM batches"
    )
    q["ingest_csv_summary"] = (
        f"WITH {batches}\nSELECT count(DISTINCT batch) FILTER (WHERE batch_index % 3 <> 0) AS sent, "
        "count(DISTINCT batch) FILTER (WHERE batch_index % 3 = 0) AS ignored, CAST(0 AS BIGINT) AS errors, count(DISTINCT batch) AS total FROM batches"
    )
    q["ingest_summary"] = (
        f"WITH {batches}\nSELECT CAST(0 AS BIGINT) AS sent, count(DISTINCT batch) AS ignored, "
        "CAST(0 AS BIGINT) AS errors, count(DISTINCT batch) AS total FROM batches"
    )
    q["ingest_first_summary"] = (
        f"WITH {batches}\nSELECT count(DISTINCT batch) AS sent, CAST(0 AS BIGINT) AS ignored, "
        "CAST(0 AS BIGINT) AS errors, count(DISTINCT batch) AS total FROM batches"
    )
    last = "(SELECT max(batch_index) FROM batches)"
    q["ingest_partial_summary"] = (
        f"WITH {batches}\nSELECT count(DISTINCT batch) - 1 AS sent, CAST(0 AS BIGINT) AS ignored, "
        "CAST(1 AS BIGINT) AS errors, count(DISTINCT batch) AS total FROM batches"
    )
    q["ingest_failed_batches"] = f"WITH {batches}\nSELECT DISTINCT dt, batch FROM batches WHERE batch_index = {last}"
    q["ingest_repaired_summary"] = (
        f"WITH {batches}\nSELECT CAST(1 AS BIGINT) AS sent, count(DISTINCT batch) - 1 AS ignored, "
        "CAST(0 AS BIGINT) AS errors, count(DISTINCT batch) AS total FROM batches"
    )
    q["ingest_rerun_rows"] = q["ingest_repaired_rows"] = (
        f"WITH {batches}\nSELECT CAST(doc_id AS VARCHAR) AS doc_id, nullif(text, '') AS text, lang, source, "
        "CAST(n_chars AS VARCHAR) AS n_chars, dt, batch FROM batches"
    )
    raw_cols = (
        'clothing_id AS "Clothing ID", age AS "Age", nullif(review_text, \'\') AS "Review Text", '
        'rating AS "Rating", recommended_ind AS "Recommended IND", '
        'nullif(department_name, \'\') AS "Department Name", dt'
    )
    q["csv_round_trip"] = f"WITH {REVIEWS_CTE}\nSELECT {raw_cols} FROM reviews"
    q["list_partitions"] = "SELECT DISTINCT CAST(CAST(ts AS DATE) AS VARCHAR) AS dt FROM events ORDER BY dt"
    # The CSV layer reads empty text cells back as null; the blank filter drops them either way.
    stored_cols = trusted_cols.replace("department_name", "nullif(department_name, '') AS department_name")
    q["trusted_round_trip"] = f"WITH {REVIEWS_CTE},{TRUSTED_CTE}\nSELECT {stored_cols} FROM trusted"
    stored = with_stored(f"SELECT {PRODUCT_COLS} FROM stored")
    q["product_round_trip"] = stored
    q["trusted_for_day"] = (
        f"WITH {REVIEWS_CTE},{TRUSTED_CTE}\nSELECT clothing_id, age, review_text, rating, recommended_ind, "
        "nullif(department_name, '') AS department_name, age_band FROM trusted WHERE dt = DATE '2024-01-15'"
    )
    q["saved_view_sql"] = with_stored(
        f"SELECT age_band, sentiment, CAST(sum(review_count) AS BIGINT) AS total_reviews, {_mean_of_means()} AS media_nota "
        "FROM stored GROUP BY age_band, sentiment ORDER BY age_band, sentiment"
    )
    q["saved_view_dept"] = with_stored(
        f"SELECT department_name, sentiment, CAST(sum(review_count) AS BIGINT) AS total_reviews, {_mean_of_means()} AS media_nota "
        "FROM stored GROUP BY department_name, sentiment ORDER BY department_name, sentiment"
    )
    q["saved_view_trend"] = with_stored(
        "SELECT dt, sentiment, CAST(sum(review_count) AS BIGINT) AS total_reviews FROM stored GROUP BY dt, sentiment ORDER BY dt, sentiment"
    )
    for name in ("idempotent_rerun", "registered_table", "incremental_product", "mixed_header_backfill", "late_rows_product"):
        q[name] = stored
    q["partition_sync"] = with_product(
        "SELECT DISTINCT 'dt=' || CAST(dt AS VARCHAR) AS partition FROM product ORDER BY partition"
    )
    days = "(SELECT count(DISTINCT CAST(ts AS DATE)) FROM events)"
    q["schema_contract"] = (
        "SELECT column_name, expected_type, actual_type, status, CAST(partitions AS BIGINT) AS partitions FROM (VALUES "
        f"('age_band', 'string', 'string', 'OK', {days}), ('department_name', 'string', 'string', 'OK', {days}), "
        f"('sentiment', 'string', 'string', 'OK', {days}), ('review_count', 'int', 'int', 'OK', {days} - 1), "
        f"('review_count', 'int', 'bigint', 'TYPE_CHANGED', 1), ('avg_rating', 'double', 'double', 'OK', {days} - 1), "
        f"('avg_rating', 'double', 'string', 'TYPE_CHANGED', 1), ('dt', 'date', 'date', 'OK', {days}), "
        "('extra', NULL, 'int', 'UNEXPECTED', 1)) AS t(column_name, expected_type, actual_type, status, partitions)"
    )
    q["schema_contract_vanished"] = (
        "SELECT column_name, expected_type, actual_type, status, CAST(partitions AS BIGINT) AS partitions FROM (VALUES "
        f"('age_band', 'string', 'string', 'OK', {days} - 1), ('department_name', 'string', 'string', 'OK', {days} - 1), "
        f"('sentiment', 'string', 'string', 'OK', {days} - 1), ('review_count', 'int', 'int', 'OK', {days} - 1), "
        f"('avg_rating', 'double', 'double', 'OK', {days} - 1), ('dt', 'date', 'date', 'OK', {days}), "
        "('dt', 'date', NULL, 'VANISHED', 1)) AS t(column_name, expected_type, actual_type, status, partitions)"
    )
    q["partition_diff"] = (
        f"WITH {DAYS_CTE}\nSELECT 'dt=' || CAST(dt AS VARCHAR) AS partition, true AS registered, dt <> {_first_day} AS stored, "
        f"CASE WHEN dt = {_first_day} THEN 'VANISHED' ELSE 'OK' END AS status FROM days "
        "UNION ALL SELECT 'dt=' || CAST(max(dt) + 1 AS VARCHAR), false, true, 'NEW' FROM days"
    )
    q["emptied_day_overwrite"] = with_stored(f"SELECT {PRODUCT_COLS} FROM stored WHERE dt <> {_first_day}")
    q["backfill_log"] = (
        f"WITH {DAYS_CTE}\nSELECT CAST(dt AS VARCHAR) AS dt, "
        f"CASE WHEN dt = {_first_day} THEN 'FAILED' ELSE 'SUCCEEDED' END AS status, "
        f"CASE WHEN dt = {_first_day} THEN 'EmptyPartition | no product rows for dt=' || CAST(dt AS VARCHAR) "
        "ELSE '' END AS error FROM days"
    )
    q["resumed_log"] = f"WITH {DAYS_CTE}\nSELECT CAST(dt AS VARCHAR) AS dt, 'SUCCEEDED' AS status, '' AS error FROM days"
    q["resumed_product"] = stored
    middle = "(SELECT min(dt) + CAST(floor((max(dt) - min(dt)) / 2) AS INTEGER) FROM product)"
    q["published_before"] = with_product(f"SELECT {PRODUCT_COLS} FROM product WHERE dt <= {middle}")
    q["published_product"] = with_product(f"SELECT {PRODUCT_COLS} FROM product WHERE dt <> {middle}")
    q["runlog_round_trip"] = (
        f"WITH {DAYS_CTE}\nSELECT CAST(dt AS VARCHAR) AS dt, "
        f"CASE WHEN dt = {_first_day} THEN 'FAILED' ELSE 'SUCCEEDED' END AS status, "
        f"CASE WHEN dt = {_first_day} THEN 'EmptyPartition | no product rows for dt=' || CAST(dt AS VARCHAR) "
        "END AS error FROM days"
    )
    q["run_summary"] = (
        f"WITH {DAYS_CTE}\nSELECT count(*) - 1 AS successes, CAST(1 AS BIGINT) AS failures, "
        "count(*) AS total, 1 AS exit_code FROM days"
    )
    return q
