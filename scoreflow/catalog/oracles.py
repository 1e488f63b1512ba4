"""The same results in plain SQL over the same tables.

The texts are written out on their own, so that they check the Spark code and
do not repeat it.
"""

# Tables derived from `orders`, put in front of a query that names them.
_FEED = """
feed AS (
  SELECT o_orderkey AS k, 'P' || o_orderkey AS "PNO", o_totalprice, o_orderdate,
         o_orderkey % 100 AS "AGE", o_custkey % 4 AS "TURN", o_orderkey % 24 AS bhour,
         o_orderkey * 7 % 50 AS "ITEM_n", o_custkey % 60 AS "ORDERDR_n", o_custkey % 5 AS "MODEL_NAME_n",
         1 + o_orderkey % 3 AS "IO_n", o_custkey % 30 AS "DEPT_n", o_orderkey % 2 AS "SEX_n",
         o_orderkey * 3 % 11 AS "POS_n", o_custkey % 40 AS "MD_NO_n"
  FROM orders)
"""

_LINES = _FEED + """
, lines AS (
  SELECT k, "PNO",
         CASE WHEN k % 101 = 0
              THEN concat_ws(',', "AGE", "TURN", bhour, "ITEM_n", "ORDERDR_n")
              WHEN k % 97 = 0
              THEN concat_ws(',', "AGE", "TURN", bhour, "ITEM_n", "ORDERDR_n", "MODEL_NAME_n",
                             "IO_n", "DEPT_n", "SEX_n", "POS_n", 'N/A')
              ELSE concat_ws(',', "AGE", "TURN", bhour, "ITEM_n", "ORDERDR_n", "MODEL_NAME_n",
                             "IO_n", "DEPT_n", "SEX_n", "POS_n", "MD_NO_n") END AS line
  FROM feed)
"""

# Fields are read from the line again; a missing or malformed one is NULL.
_PARSED = _LINES + """
, fields AS (SELECT k, "PNO", line, string_split(line, ',') AS f FROM lines)
, parsed AS (
  SELECT k, "PNO", line,
    CASE WHEN regexp_full_match(f[1], '[+-]?[0-9]+') THEN CAST(f[1] AS BIGINT) END AS "AGE",
    CASE WHEN regexp_full_match(f[2], '[+-]?[0-9]+') THEN CAST(f[2] AS BIGINT) END AS "TURN",
    CASE WHEN regexp_full_match(f[3], '[+-]?[0-9]+') THEN CAST(f[3] AS BIGINT) END AS bhour,
    CASE WHEN regexp_full_match(f[4], '[+-]?[0-9]+') THEN CAST(f[4] AS BIGINT) END AS "ITEM_n",
    CASE WHEN regexp_full_match(f[5], '[+-]?[0-9]+') THEN CAST(f[5] AS BIGINT) END AS "ORDERDR_n",
    CASE WHEN regexp_full_match(f[6], '[+-]?[0-9]+') THEN CAST(f[6] AS BIGINT) END AS "MODEL_NAME_n",
    CASE WHEN regexp_full_match(f[7], '[+-]?[0-9]+') THEN CAST(f[7] AS BIGINT) END AS "IO_n",
    CASE WHEN regexp_full_match(f[8], '[+-]?[0-9]+') THEN CAST(f[8] AS BIGINT) END AS "DEPT_n",
    CASE WHEN regexp_full_match(f[9], '[+-]?[0-9]+') THEN CAST(f[9] AS BIGINT) END AS "SEX_n",
    CASE WHEN regexp_full_match(f[10], '[+-]?[0-9]+') THEN CAST(f[10] AS BIGINT) END AS "POS_n",
    CASE WHEN regexp_full_match(f[11], '[+-]?[0-9]+') THEN CAST(f[11] AS BIGINT) END AS "MD_NO_n"
  FROM fields)
, good AS (
  SELECT * FROM parsed
  WHERE "AGE" IS NOT NULL AND "TURN" IS NOT NULL AND bhour IS NOT NULL AND "ITEM_n" IS NOT NULL
    AND "ORDERDR_n" IS NOT NULL AND "MODEL_NAME_n" IS NOT NULL AND "IO_n" IS NOT NULL
    AND "DEPT_n" IS NOT NULL AND "SEX_n" IS NOT NULL AND "POS_n" IS NOT NULL AND "MD_NO_n" IS NOT NULL)
"""

_FOREST = """
  CAST(
    CASE WHEN "AGE" <= 50 THEN CASE WHEN "ITEM_n" <= 24 THEN 600 ELSE 1207 END
         ELSE CASE WHEN "IO_n" <= 1 THEN -90 ELSE 1501 END END
  + CASE WHEN "DEPT_n" <= 14 THEN CASE WHEN "SEX_n" <= 0 THEN 318 ELSE 905 END
         ELSE CASE WHEN "POS_n" <= 5 THEN 1402 ELSE -31 END END
  + CASE WHEN "ORDERDR_n" <= 30 THEN CASE WHEN bhour <= 11 THEN 122 ELSE -2003 END
         ELSE CASE WHEN "TURN" <= 1 THEN 777 ELSE 1810 END END
  + CASE WHEN "MODEL_NAME_n" <= 2 THEN CASE WHEN "MD_NO_n" <= 19 THEN -457 ELSE 250 END
         ELSE CASE WHEN "AGE" <= 25 THEN 63 ELSE 999 END END AS DOUBLE) / 4.0
"""

# 200 full trees of five levels. Node n has the children 2n and 2n+1; feature, threshold and leaf follow
# from the numbers of tree and node.
_LARGE_STEP = """
  SELECT "PNO", x, tree, 2 * node + CASE WHEN x[1 + (tree * 7 + node * 3) % 11] <= (tree * 13 + node * 17) % 50
                                       THEN 0 ELSE 1 END AS node FROM """
_LARGE_SCORED = f"""WITH {_PARSED}
, level0 AS (
  SELECT "PNO", ["AGE", "TURN", bhour, "ITEM_n", "ORDERDR_n", "MODEL_NAME_n", "IO_n", "DEPT_n", "SEX_n", "POS_n",
         "MD_NO_n"] AS x, tree, 1 AS node FROM good, range(200) AS trees(tree))
{"".join(f", level{i} AS ({_LARGE_STEP} level{i - 1})" for i in range(1, 6))}
SELECT "PNO", CAST(sum((tree * 31 + node * 97) % 2001 - 500) AS DOUBLE) AS prediction FROM level5 GROUP BY "PNO"
"""

_FOREST_SCORED = _PARSED + f"""
, scored AS (SELECT k, "PNO", {_FOREST} AS prediction FROM good)
"""

_FOREST_MINUTES = _FOREST_SCORED + """
, timed AS (
  SELECT "PNO", prediction, CAST(trunc(prediction) AS BIGINT) AS seconds,
         CAST(floor(trunc(prediction) / 60) AS BIGINT) AS minutes
  FROM scored)
"""

_KEYED = _FEED + """
, whole AS (
  SELECT "PNO", o_orderdate, CAST(trunc(o_totalprice / 100) AS BIGINT) AS "Item",
         "ORDERDR_n" AS "ORDERDR", "DEPT_n" AS "DEPT", "SEX_n" AS "SEX", "AGE", "POS_n" AS "POS", "IO_n" AS "IO"
  FROM feed)
"""

_KEYED_SCORED = _KEYED + """
, boosted AS (
  SELECT "PNO", o_orderdate, 420.5 + CAST(
      CASE WHEN "Item" < 1500 THEN CASE WHEN "AGE" < 40 THEN 300 ELSE -611 END
           ELSE CASE WHEN "IO" < 3 THEN 1207 ELSE 95 END END
    + CASE WHEN "DEPT" < 10 THEN CASE WHEN "SEX" < 1 THEN -40 ELSE 233 END
           ELSE CASE WHEN "POS" < 6 THEN 610 ELSE -275 END END
    + CASE WHEN "ORDERDR" < 45 THEN CASE WHEN "AGE" < 70 THEN 18 ELSE 144 END
           ELSE CASE WHEN "Item" < 3000 THEN -9 ELSE 75 END END AS DOUBLE) AS prediction
  FROM whole)
, timed AS (
  SELECT "PNO", o_orderdate, prediction, CAST(trunc(prediction) AS BIGINT) AS seconds,
         CAST(floor(trunc(prediction) / 60) AS BIGINT) AS minutes
  FROM boosted)
"""

_PEOPLE = _FEED + """
, people AS (
  SELECT "PNO", "ITEM_n" AS "Item", "ORDERDR_n" AS "ORDERDR", "DEPT_n" AS "DEPT", "SEX_n" AS "SEX",
         "AGE", "POS_n" AS "POS", "IO_n" AS "IO", 60 + k % 3600 AS "SECOND"
  FROM feed)
"""

_FEATURES = '"AGE", "TURN", bhour, "ITEM_n", "ORDERDR_n", "MODEL_NAME_n", "IO_n", "DEPT_n", "SEX_n", "POS_n", "MD_NO_n"'
_MINUTES = """'The Patient NO. is ' || "PNO" || ', need ' || minutes || ' minutes to detect by MRI'"""
_PAGE_IMAGE = (
    "SELECT page_id, CAST(strlen(html) AS BIGINT) AS width, CAST(1 AS BIGINT) AS height, "
    "CAST(1 AS BIGINT) AS channels, md5(html) AS pixels_md5 FROM pages"
)

ORACLES: dict[str, str] = {
    "text_scan_nonblank": f'WITH {_LINES} SELECT line AS "value" FROM lines',
    "csv_header_inferred": f"""WITH {_PEOPLE}
        SELECT "PNO", CAST("Item" AS INTEGER) AS "Item", CAST("ORDERDR" AS INTEGER) AS "ORDERDR",
               CAST("DEPT" AS INTEGER) AS "DEPT", CAST("SEX" AS INTEGER) AS "SEX", CAST("AGE" AS INTEGER) AS "AGE",
               CAST("POS" AS INTEGER) AS "POS", CAST("IO" AS INTEGER) AS "IO", CAST("SECOND" AS INTEGER) AS "SECOND"
        FROM people""",
    "filter_int_field": f'WITH {_PARSED} SELECT "PNO", line AS "value" FROM parsed WHERE "MD_NO_n" IS NOT NULL',
    "parse_mri11": f'WITH {_PARSED} SELECT "PNO", {_FEATURES} FROM good',
    "parse_mri11_nulls": f'WITH {_PARSED} SELECT "PNO", {_FEATURES} FROM parsed',
    "parse_kafka8": f"""WITH {_FEED}
        SELECT "AGE" AS "F0", "TURN" AS "F1", bhour AS "F2", "ITEM_n" AS "F3", "ORDERDR_n" AS "F4",
               "MODEL_NAME_n" AS "F5", "IO_n" AS "F6", "DEPT_n" AS "F7" FROM feed""",
    "parse_keyed7_truncate":
        f'WITH {_KEYED} SELECT "PNO", "Item", "ORDERDR", "DEPT", "SEX", "AGE", "POS", "IO" FROM whole',
    "cast_int_columns": f'WITH {_PARSED} SELECT "PNO", {_FEATURES} FROM good',
    "vector_assemble": f"""WITH {_FEED}
        SELECT "PNO", "AGE" AS v0, "TURN" AS v1, bhour AS v2, "ITEM_n" AS v3, "ORDERDR_n" AS v4,
               "MODEL_NAME_n" AS v5, "IO_n" AS v6, "DEPT_n" AS v7, "SEX_n" AS v8, "POS_n" AS v9,
               "MD_NO_n" AS v10 FROM feed""",
    "zip_arrays": f"""WITH {_FEED}
        SELECT "PNO", CAST(unnest(range(11)) AS BIGINT) AS position,
               CAST(unnest([{_FEATURES}]) AS DOUBLE) AS field_value FROM feed""",
    "people_sql": f'WITH {_PEOPLE} SELECT "PNO", "SECOND" FROM people WHERE "AGE" > 20 AND "IO" = 2',
    "people_sql_parquet": f'WITH {_PEOPLE} SELECT "PNO", "SECOND" FROM people WHERE "AGE" > 20 AND "IO" = 2',
    "dense_index": """SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS row_id,
        o_orderkey, o_custkey, o_totalprice FROM orders""",
    "dense_index_hot_key": """
        WITH ids AS (SELECT o_orderstatus, row_number() OVER (ORDER BY o_orderstatus) - 1 AS row_id FROM orders)
        SELECT o_orderstatus, min(row_id) AS first_id, max(row_id) AS last_id, count(*) AS n_rows,
               count(*) - count(DISTINCT row_id) AS repeated_ids
        FROM ids GROUP BY o_orderstatus""",
    "dense_index_partition_order": """
        SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS first_id, count(*) - 1 AS last_id,
               CAST(0 AS BIGINT) AS repeated_ids, count(DISTINCT o_orderkey) AS n_keys FROM orders""",
    "score_trees_large": _LARGE_SCORED,
    "score_trees_masks": _LARGE_SCORED,
    "score_flat_forest": """
        WITH edges AS (
          SELECT 'P' || o_orderkey AS "PNO", CAST(CAST(o_totalprice AS REAL) AS DOUBLE) AS price,
                 CAST(CAST(16777208 + o_orderkey % 16 + 0.25::DOUBLE * (o_custkey % 4) AS REAL) AS DOUBLE) AS far FROM orders)
        SELECT "PNO", prediction, prediction AS by_masks FROM (
          SELECT "PNO", (CASE WHEN far <= 16777217.0 THEN CASE WHEN price <= 150000.015625 THEN 120.25 ELSE -61.0 END ELSE 480.5 END
            + CASE WHEN far <= 16777215.99::DOUBLE THEN 30.0 WHEN far <= 16777218.5 THEN 90.75 ELSE 1207.5 END)::DOUBLE / 2 AS prediction
          FROM edges)""",
    "score_boosted_import": f"""WITH {_PARSED}
, halves AS (
  SELECT "PNO",
    CASE WHEN CAST("AGE" AS REAL) < CAST(49.5 AS REAL)
         THEN CASE WHEN "MD_NO_n" IS NULL OR CAST("MD_NO_n" AS REAL) < CAST(20.1 AS REAL) THEN 59.6 ELSE 119.7 END
         ELSE CASE WHEN CAST("IO_n" AS REAL) < CAST(1.5 AS REAL) THEN 0.1 ELSE 179.9 END END AS one,
    CASE WHEN "ITEM_n" IS NULL OR CAST("ITEM_n" AS REAL) < CAST(24.3 AS REAL)
         THEN CASE WHEN "DEPT_n" IS NULL OR CAST("DEPT_n" AS REAL) < CAST(14.7 AS REAL) THEN 0.1 ELSE 60.05 END
         ELSE CASE WHEN "SEX_n" IS NULL OR CAST("SEX_n" AS REAL) < CAST(0.5 AS REAL) THEN 0.2 ELSE -0.4 END END AS two,
    CASE WHEN CAST("MD_NO_n" AS REAL) < CAST(30.2 AS REAL)
         THEN CASE WHEN CAST("POS_n" AS REAL) < CAST(5.5 AS REAL) THEN 0.2 ELSE 0.3 END
         ELSE CASE WHEN CAST(bhour AS REAL) < CAST(11.9 AS REAL) THEN 0.05 ELSE 119.95 END END AS three
  FROM parsed)
, summed AS (
  SELECT "PNO", CAST(CAST(0.1 AS REAL) + CAST(one AS REAL) + CAST(two AS REAL) + CAST(three AS REAL) AS DOUBLE)
           AS prediction FROM halves)
SELECT "PNO", prediction, CAST(trunc(prediction) AS BIGINT) AS seconds,
       CAST(floor(trunc(prediction) / 60) AS BIGINT) AS minutes FROM summed""",
    "parse_rejects": f"""WITH {_LINES}
        SELECT "PNO", line, CASE WHEN k % 101 = 0 THEN 'short' ELSE 'field MD_NO_n' END AS reason
        FROM lines WHERE k % 101 = 0 OR k % 97 = 0""",
    "score_column": f'WITH {_FOREST_SCORED} SELECT "PNO", prediction FROM scored',
    "score_python_broadcast": f'WITH {_FOREST_SCORED} SELECT "PNO", prediction FROM scored',
    "score_batches": f'WITH {_FOREST_SCORED} SELECT "PNO", prediction FROM scored',
    "score_indexed":
        f"WITH {_FOREST_SCORED} SELECT row_number() OVER (ORDER BY k) - 1 AS row_id, prediction FROM scored",
    "score_keyed_minutes": f'WITH {_KEYED_SCORED} SELECT "PNO", prediction, seconds, minutes FROM timed',
    "score_mllib_forest": f'WITH {_PARSED} SELECT "PNO", CAST(1 AS INTEGER) AS agrees FROM good',
    "score_mllib_boosted": f'WITH {_PARSED} SELECT "PNO", CAST(1 AS INTEGER) AS agrees FROM good',
    "mape": f"""WITH {_FEED}
        SELECT round(avg(abs((60 + k % 3600 - {_FOREST}) / nullif(60 + k % 3600, 0))) * 100, 6) AS mape FROM feed""",
    "sink_text_roundtrip": f"WITH {_FOREST_SCORED} SELECT prediction FROM scored",
    "sink_csv_roundtrip": f'WITH {_FOREST_MINUTES} SELECT "PNO", prediction, seconds, minutes FROM timed',
    "sink_parquet_roundtrip": f'WITH {_FOREST_MINUTES} SELECT "PNO", prediction, seconds, minutes FROM timed',
    "sink_table_roundtrip": f'WITH {_FOREST_MINUTES} SELECT "PNO", minutes AS "PRETIME" FROM timed',
    "result_table_rows": f"""WITH {_KEYED_SCORED}
        SELECT "PNO", minutes AS "PRETIME", strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS "Time" FROM timed""",
    "message_minutes": f'WITH {_KEYED_SCORED} SELECT "PNO", {_MINUTES} AS message FROM timed',
    "message_seconds": f"""WITH {_KEYED_SCORED}
        SELECT "PNO", 'The AI predict that ' || prediction || ' seconds to detect from  MRI' AS message,
               'This patient need ' || prediction || ' seconds to detect from MRI' AS line FROM timed""",
    "message_line": f"""WITH {_KEYED_SCORED} SELECT "PNO" || ',' || minutes AS line FROM timed""",
    "preview": f"""WITH {_FOREST_MINUTES}
        SELECT "PNO", prediction, seconds, minutes FROM timed ORDER BY prediction DESC, "PNO" LIMIT 20""",
    "stream_score_replay": f"WITH {_FOREST_SCORED} SELECT prediction FROM scored",
    "stream_kafka8_seconds": f"""WITH {_FEED}, stepped AS (
        SELECT "PNO", CAST(500 +
            CASE WHEN "AGE" <= 30 THEN CASE WHEN "ITEM_n" <= 20 THEN 120 ELSE 240 END
                 ELSE CASE WHEN "IO_n" <= 2 THEN -75 ELSE 410 END END
          + CASE WHEN "DEPT_n" <= 12 THEN CASE WHEN "TURN" <= 0 THEN 33 ELSE -66 END
                 ELSE CASE WHEN "MODEL_NAME_n" <= 3 THEN 150 ELSE -20 END END AS DOUBLE) AS prediction
        FROM feed)
        SELECT "PNO", prediction,
               'The AI predict that ' || prediction || ' seconds to detect from  MRI' AS message FROM stepped""",
    "stream_fan_out": f"""WITH {_KEYED_SCORED}
        SELECT 'table' AS sink, "PNO" || ',' || minutes AS line FROM timed
        UNION ALL SELECT 'topic', {_MINUTES} FROM timed
        UNION ALL SELECT 'file', "PNO" || ',' || minutes FROM timed""",
    "stream_ledger_delivery": f"""WITH {_KEYED_SCORED}
        SELECT sink, "PNO" || ',' || minutes AS line FROM timed, (VALUES ('first'), ('failing'), ('last')) AS sinks(sink)""",
    "stream_messages_once": f'WITH {_KEYED_SCORED} SELECT "PNO", {_MINUTES} AS message FROM timed',
    "first_delivery_rows": f"WITH {_KEYED_SCORED} SELECT minutes, count(*) AS n_rows FROM timed GROUP BY minutes",
    "stream_mape": f"""WITH {_FEED}
        SELECT round(avg(abs((60 + k % 3600 - {_FOREST}) / nullif(60 + k % 3600, 0))) * 100, 6) AS mape,
               true AS several_batches FROM feed""",
    "stream_sql_batches": f"""WITH {_KEYED_SCORED}
        SELECT minutes, CAST(count(*) AS BIGINT) AS n_rows, CAST(sum(seconds) AS BIGINT) AS total FROM timed GROUP BY minutes""",
    "stream_dense_index": f"""WITH {_KEYED_SCORED}
        SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS first_id, count(*) - 1 AS last_id, count(*) AS n_ids,
               count(DISTINCT "PNO") AS n_keys FROM timed""",
    "stream_named_projection": f"""WITH {_FEED}
        SELECT o_totalprice / 100 AS "PNO", CAST("ORDERDR_n" AS VARCHAR) AS usetime FROM feed""",
    "stream_events_parquet": """SELECT CAST(user_id AS VARCHAR) AS "key",
        concat_ws(',', event_id, event_type, props) AS "value" FROM events""",
    "utf8_clean": 'SELECT page_id, html AS "text" FROM pages',
    "utf8_encode": "SELECT page_id, CAST(strlen(html) AS BIGINT) AS size, md5(html) AS bytes_md5 FROM pages",
    "image_read": _PAGE_IMAGE,
    "image_stream": _PAGE_IMAGE,
    "image_payload_stream": """
        SELECT page_id, CAST(strlen(html) AS BIGINT) AS width, CAST(1 AS BIGINT) AS height,
               CAST(CASE WHEN page_id % 3 = 2 THEN 3 ELSE 1 END AS BIGINT) AS channels,
               md5(unhex(CASE page_id % 3 WHEN 0 THEN hex(html)
                         WHEN 1 THEN regexp_replace(hex(html), '(..)', '\\1\\1', 'g')
                         ELSE regexp_replace(hex(html), '(..)', '\\1\\1\\1', 'g') END)) AS pixels_md5 FROM pages""",
}
