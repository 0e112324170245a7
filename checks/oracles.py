"""DuckDB SQL that must return the rows of the query of the same name."""

from __future__ import annotations

from checks.queries import (
    BASKET_CONFIDENCE,
    BASKET_SUPPORT,
    CENTRES,
    EVENT_BATCH,
    MEASURES,
    ORDER_BATCH,
    PART_BATCH,
)
from checks.samples import APP_ROWS, DAMAGE, EVENT_FIELDS, accepted_sql, sql_csv_line
from marketloom.schema import BATCH_COLUMNS, FEATURES, MIN_SUPPORT

APPS = APP_ROWS.format(part="part")
BATCH_LIST = ", ".join(f'"{c}"' for c in BATCH_COLUMNS)

CLEAN = f"""
SELECT id, Category,
  TRY_CAST(Rating AS DOUBLE) AS Rating,
  TRY_CAST(Reviews AS DOUBLE) AS Reviews,
  CASE WHEN ends_with(Size, 'M') THEN TRY_CAST(regexp_replace(Size, 'M', '', 'g') AS DOUBLE)
       WHEN ends_with(Size, 'k') THEN TRY_CAST(regexp_replace(Size, 'k', '', 'g') AS DOUBLE) / 1024
       END AS Size,
  TRY_CAST(regexp_replace(Installs, '[+,]', '', 'g') AS DOUBLE) AS Installs,
  TRY_CAST(regexp_replace(Price, '[$]', '', 'g') AS DOUBLE) AS Price
FROM ({APPS})
"""

REAL_RATING = "CASE WHEN isnan(Rating) THEN NULL ELSE Rating END"

FILLED = f"""
SELECT id, coalesce({REAL_RATING}, avg({REAL_RATING}) OVER (), 0.0) AS Rating,
  coalesce(Reviews, 0.0) AS Reviews, coalesce(Size, 0.0) AS Size,
  coalesce(Installs, 0.0) AS Installs, coalesce(Price, 0.0) AS Price,
  coalesce(Category, 'Unknown') AS Category
FROM ({CLEAN})
"""

ITEMS = f"""
SELECT coalesce(Category, 'Unknown') AS item, count(*) AS freq FROM ({APPS}) GROUP BY 1
HAVING count(*) >= ceil(CAST({MIN_SUPPORT} AS DOUBLE) * (SELECT count(*) FROM part))
"""

NUMBERED = f"""
SELECT *, row_number() OVER (ORDER BY event_id) AS row_no,
  CAST((row_number() OVER (ORDER BY event_id) - 1) // {EVENT_BATCH} + 1 AS BIGINT) AS batch_no
FROM ({accepted_sql()})
"""

REMAINDER = f"batch_no > (SELECT count(*) FROM events WHERE {DAMAGE} = 'good') // {EVENT_BATCH}"

ORDER_SNAPSHOT = f"""
SELECT o_orderkey, o_custkey, o_totalprice,
  CAST((row_number() OVER (ORDER BY o_orderkey) - 1) // {ORDER_BATCH} + 1 AS BIGINT) AS batch_no
FROM orders
"""

BASKETS = """
WITH b AS (SELECT DISTINCT l_orderkey AS k, p_brand AS i
           FROM lineitem JOIN part ON l_partkey = p_partkey),
least_count AS (SELECT ceil(CAST({support} AS DOUBLE) * count(DISTINCT k)) AS n FROM b),
one AS (SELECT i AS a, count(*) AS freq FROM b GROUP BY i
        HAVING count(*) >= (SELECT n FROM least_count)),
two AS (SELECT x.i AS a, y.i AS c, count(*) AS freq FROM b x JOIN b y ON x.k = y.k AND x.i < y.i
        GROUP BY ALL HAVING count(*) >= (SELECT n FROM least_count)),
three AS (SELECT x.i AS a, y.i AS c, z.i AS d, count(*) AS freq
          FROM b x JOIN b y ON x.k = y.k AND x.i < y.i JOIN b z ON z.k = y.k AND y.i < z.i
          GROUP BY ALL HAVING count(*) >= (SELECT n FROM least_count)),
four AS (SELECT x.i AS a, y.i AS c, z.i AS d, w.i AS e, count(*) AS freq
         FROM b x JOIN b y ON x.k = y.k AND x.i < y.i JOIN b z ON z.k = y.k AND y.i < z.i
         JOIN b w ON w.k = z.k AND z.i < w.i
         GROUP BY ALL HAVING count(*) >= (SELECT n FROM least_count))
""".format(support=BASKET_SUPPORT)

ITEMSETS = """
SELECT a AS items, 1 AS set_size, freq FROM one
UNION ALL SELECT a || ',' || c, 2, freq FROM two
UNION ALL SELECT a || ',' || c || ',' || d, 3, freq FROM three
UNION ALL SELECT a || ',' || c || ',' || d || ',' || e, 4, freq FROM four
"""

# Rules of every frequent set: one item as the consequent, the others before it.
RULES = f"""
sets AS ({ITEMSETS}),
splits AS (
  SELECT a AS antecedent, c AS consequent, freq FROM two
  UNION ALL SELECT c, a, freq FROM two
  UNION ALL SELECT a || ',' || c, d, freq FROM three
  UNION ALL SELECT a || ',' || d, c, freq FROM three
  UNION ALL SELECT c || ',' || d, a, freq FROM three
  UNION ALL SELECT a || ',' || c || ',' || d, e, freq FROM four
  UNION ALL SELECT a || ',' || c || ',' || e, d, freq FROM four
  UNION ALL SELECT a || ',' || d || ',' || e, c, freq FROM four
  UNION ALL SELECT c || ',' || d || ',' || e, a, freq FROM four)
"""

REQUESTS = """
SELECT o_orderkey AS request_id, o_custkey, o_orderpriority,
  CASE o_orderstatus WHEN 'F' THEN 'model1' WHEN 'O' THEN 'model3' ELSE 'model2' END AS model,
  CASE WHEN o_orderstatus = 'P' AND o_totalprice >= 300000 THEN 'unknown_model'
       WHEN o_totalprice < 8000 THEN 'bad_request'
       WHEN o_totalprice < 16000 THEN 'invalid'
       WHEN o_totalprice < 20000 THEN 'bad_request'
       ELSE 'ok' END AS status
FROM orders
"""


def _zeroed(value: str) -> str:
    return f"CASE WHEN status = 'ok' THEN CAST({value} AS DOUBLE) ELSE 0.0 END"


def _round(value: str, digits: int = 6) -> str:
    return f"round({value}, {digits}) + 0.0"


def _squared(centre: tuple[float, ...]) -> str:
    return " + ".join(
        f"({c} - CAST({v} AS DOUBLE)) * ({c} - CAST({v} AS DOUBLE))"
        for c, v in zip(MEASURES, centre, strict=True)
    )


def _moments() -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, count({c}) AS row_count, {_round(f'avg({c})')} AS mean, "
        f"{_round(f'stddev_samp({c})')} AS std FROM lineitem"
        for c in MEASURES
    )


def _covariances() -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, "
        f"{_round(f'covar_samp({a}, {b})', 4)} AS covariance FROM lineitem"
        for i, a in enumerate(MEASURES)
        for b in MEASURES[i:]
    )


SCALED = "SELECT l_orderkey, l_linenumber, " + ", ".join(
    f"{_round(f'{c} / stddev_samp({c}) OVER ()')} AS scaled_{c}" for c in MEASURES
) + " FROM lineitem"

_LENGTH = " + ".join(f"pow({c} / stddev_samp({c}) OVER (), 2)" for c in MEASURES)

_LINE = sql_csv_line(EVENT_FIELDS)

_APP_BATCH = f"""
SELECT *, (row_number() OVER (ORDER BY id) - 1) // {PART_BATCH} + 1 AS batch_no FROM ({CLEAN})
"""


def _per_snapshot(body: str) -> str:
    """``body`` for the first batch, the first two, and all; ``{name}`` and ``{rows}`` inside."""
    limits = (("model1", "batch_no <= 1"), ("model2", "batch_no <= 2"), ("model3", "true"))
    return " UNION ALL ".join(
        body.format(name=name, rows=f"(SELECT * FROM ({_APP_BATCH}) WHERE {limit})")
        for name, limit in limits
    )


ORACLES: dict[str, str] = {
    "frequent_event_types": f"""
        SELECT event_type AS item, count(*) AS freq FROM events WHERE {DAMAGE} = 'good'
        GROUP BY 1 HAVING count(*) >= ceil(CAST({MIN_SUPPORT} AS DOUBLE) *
          (SELECT count(*) FROM events WHERE {DAMAGE} = 'good'))""",
    "wire_roundtrip": "SELECT event_id, "
    + ", ".join(f"nullif({f}, '') AS c{i}" for i, f in enumerate(EVENT_FIELDS))
    + " FROM events",
    "wire_text_roundtrip": """
        SELECT doc_id, nullif(text, '') AS text, lang, source, n_chars
        FROM documents""",
    "raw_csv_records": """
        SELECT conv_id, turn, role, nullif(text, '') AS text
        FROM conversations""",
    "dataset_ingest": f"""
        SELECT conv_id, turn, CAST(dense_rank() OVER (ORDER BY role) - 1 AS INTEGER) AS "partition",
          row_number() OVER (PARTITION BY role ORDER BY conv_id, turn) - 1 AS "offset",
          CAST((row_number() OVER (ORDER BY role, conv_id, turn) - 1) // {EVENT_BATCH} + 1 AS BIGINT) AS batch_no
        FROM conversations""",
    "raw_csv_rows": "SELECT conv_id, turn, role, nullif(text, '') AS text FROM conversations",
    "arity_rejects": f"""
        SELECT event_id AS "offset",
          CASE damage WHEN 'empty' THEN 'empty' WHEN 'short' THEN 'arity' WHEN 'long' THEN 'arity'
            WHEN 'bytes' THEN 'encoding' ELSE 'parse' END AS reason,
          CASE damage WHEN 'short' THEN 23 WHEN 'long' THEN 25 END AS field_count,
          CASE damage WHEN 'empty' THEN ''
            WHEN 'short' THEN substr(trim(short_line), 1, 100)
            WHEN 'long' THEN substr(line || ',more', 1, 100)
            WHEN 'return' THEN substr('x' || chr(13) || 'y,' || line, 1, 100) END AS preview
        FROM (SELECT event_id, {DAMAGE} AS damage, {_LINE} AS line,
                {sql_csv_line(EVENT_FIELDS[:-1])} AS short_line FROM events)
        WHERE damage <> 'good'""",
    "reject_reasons": f"""
        SELECT CASE {DAMAGE} WHEN 'empty' THEN 'empty' WHEN 'short' THEN 'arity'
            WHEN 'long' THEN 'arity' WHEN 'bytes' THEN 'encoding' WHEN 'return' THEN 'parse'
            ELSE 'accepted' END AS outcome, count(*) AS messages
        FROM events GROUP BY 1""",
    "project_by_position": f"SELECT event_id, {BATCH_LIST} FROM ({accepted_sql()})",
    "count_window_batches": f"SELECT event_id, row_no, batch_no FROM ({NUMBERED})",
    "remainder_batch": f"SELECT event_id, batch_no FROM ({NUMBERED}) WHERE {REMAINDER}",
    "batch_file_order": """
        WITH n AS (
          SELECT CAST((row_number() OVER (ORDER BY event_id) - 1) // 100 + 1 AS BIGINT) AS batch_no,
            ts FROM events),
        f AS (SELECT batch_no,
            'batch_' || batch_no || '_' || strftime(max(ts), '%Y%m%d%H%M%S') || '.csv' AS file_name
          FROM n GROUP BY batch_no)
        SELECT file_name, batch_no, row_number() OVER (ORDER BY batch_no) AS numeric_rank,
          row_number() OVER (ORDER BY file_name) AS lexical_rank FROM f""",
    "batch_csv_roundtrip": f"""
        SELECT {BATCH_LIST}, batch_no, {REMAINDER} AS is_remainder FROM ({NUMBERED})""",
    "cumulative_snapshots": f"""
        WITH o AS ({ORDER_SNAPSHOT})
        SELECT 'model1' AS snapshot, * FROM o WHERE batch_no <= 1
        UNION ALL SELECT 'model2', * FROM o WHERE batch_no <= 2
        UNION ALL SELECT 'model3', * FROM o""",
    "clean_features": f"SELECT id, {', '.join(FEATURES)} FROM ({CLEAN})",
    "mean_fill": f"SELECT id, {', '.join(f'{_round(c)} AS {c}' for c in FEATURES)} FROM ({FILLED})",
    "category_fill": f"SELECT id, Category FROM ({FILLED})",
    "drop_incomplete": f"""
        SELECT id, Category, {', '.join(FEATURES)} FROM ({CLEAN})
        WHERE Category IS NOT NULL AND """
    + " AND ".join(f"{c} IS NOT NULL AND NOT isnan({c})" for c in FEATURES),
    # One NaN makes the mean NaN, so rows without a real rating cannot be filled.
    "propagated_nan": f"""
        SELECT f.id, f.Rating, f.Reviews, f.Size, f.Installs, f.Price, f.Category
        FROM ({FILLED}) f JOIN ({CLEAN}) c ON f.id = c.id
        WHERE NOT (SELECT bool_or(coalesce(isnan(Rating), false)) FROM ({CLEAN}))
          OR (c.Rating IS NOT NULL AND NOT isnan(c.Rating))""",
    "row_quality_profile": f"""
        SELECT count(*) AS row_count,
          count_if({' AND '.join(f'{c} IS NOT NULL AND NOT isnan({c})' for c in FEATURES)}
            AND Category IS NOT NULL)::BIGINT AS complete_rows,
          {', '.join(f'count_if({c} IS NULL OR isnan({c}))::BIGINT AS missing_{c.lower()}'
                     for c in FEATURES)},
          count_if(Category IS NULL)::BIGINT AS missing_category
        FROM ({CLEAN})""",
    "snapshot_mean_fill": _per_snapshot(
        f"SELECT '{{name}}' AS snapshot, id, "
        f"round(coalesce({REAL_RATING}, avg({REAL_RATING}) OVER (), 0.0), 6) + 0.0 AS Rating "
        f"FROM {{rows}}"
    ),
    "single_item_support": ITEMS,
    "single_item_growth": ITEMS,
    "basket_itemsets": f"{BASKETS} {ITEMSETS}",
    "association_rules": f"""{BASKETS}, {RULES}
        SELECT s.antecedent, s.consequent,
          {_round('CAST(s.freq AS DOUBLE) / l.freq')} AS confidence,
          {_round('(CAST(s.freq AS DOUBLE) / l.freq) / (CAST(r.freq AS DOUBLE) / t.n)')} AS lift,
          {_round('CAST(s.freq AS DOUBLE) / t.n')} AS support
        FROM splits s JOIN sets l ON l.items = s.antecedent JOIN sets r ON r.items = s.consequent,
          (SELECT count(DISTINCT k) AS n FROM b) t
        WHERE CAST(s.freq AS DOUBLE) / l.freq >= CAST({BASKET_CONFIDENCE} AS DOUBLE)""",
    "feature_moments": _moments(),
    "covariance_matrix": _covariances(),
    "scaled_features": SCALED,
    "scaled_by_deviation": SCALED,
    "nearest_centroid": "SELECT l_orderkey, l_linenumber, list_min(["
    + ", ".join(f"struct_pack(d := {_squared(c)}, i := {i})" for i, c in enumerate(CENTRES))
    + "]).i AS centre FROM lineitem",
    "kmeans_assignment_check": """
        SELECT count(*) AS row_count, CAST(0 AS BIGINT) AS misassigned, true AS all_centres_used
        FROM lineitem""",
    "kmeans_known_clusters": f"""
        SELECT count(*) AS size, {_round('avg((o_custkey % 10) * 1000 + o_orderkey % 7)', 4)} AS x,
          {_round('avg((o_custkey % 10) * (o_custkey % 10) * 100 + o_orderkey % 5)', 4)} AS y
        FROM orders GROUP BY o_custkey % 10""",
    "pca_component_check": f"""
        SELECT CAST({len(MEASURES)} AS DOUBLE) AS total,
          round({' + '.join(f'pow(corr({a}, {b}), 2)' for a in MEASURES for b in MEASURES)}, 6) AS squares,
          CAST(0 AS DOUBLE) AS "between", true AS falling, true AS same_first
        FROM lineitem""",
    "pca_rotation_check": f"""
        SELECT l_orderkey, l_linenumber, {_round(_LENGTH, 4)} AS squared_length FROM lineitem""",
    "score_request_answers": f"""
        SELECT request_id,
          CASE status WHEN 'ok' THEN 200 WHEN 'bad_request' THEN 400
            WHEN 'unknown_model' THEN 404 ELSE 500 END AS code,
          CASE WHEN status = 'ok' THEN 'kmeans_' || model END AS model_used,
          CASE WHEN status = 'ok' THEN o_custkey END AS reviews,
          CASE WHEN status = 'ok' THEN o_orderpriority END AS tag,
          CASE WHEN status = 'ok' THEN true END AS has_cluster,
          status <> 'ok' AS has_error
        FROM ({REQUESTS})""",
    "score_value_check": f"""
        SELECT prefix || model AS artifact, count(*) AS requests, CAST(0 AS BIGINT) AS wrong
        FROM ({REQUESTS}), (SELECT unnest(['kmeans_', 'pca_']) AS prefix)
        WHERE status = 'ok' GROUP BY 1""",
    "score_request_status": f"""
        SELECT request_id, status,
          CASE status WHEN 'ok' THEN 200 WHEN 'bad_request' THEN 400
            WHEN 'unknown_model' THEN 404 ELSE 500 END AS code,
          {_zeroed('o_custkey % 6')} AS rating, {_zeroed('o_custkey')} AS reviews,
          {_zeroed('o_custkey % 50 + 0.5')} AS size,
          {_zeroed('(o_custkey % 90) * 1000')} AS installs, CAST(0.0 AS DOUBLE) AS price
        FROM ({REQUESTS})""",
    "itemset_json": f"""
        SELECT 'fpgrowth_results_model3' AS results_used, item AS items, freq FROM ({ITEMS})""",
    "trained_itemsets": _per_snapshot(
        "SELECT '{name}' AS snapshot, coalesce(Category, 'Unknown') AS item, count(*) AS freq "
        "FROM {rows} GROUP BY 2 HAVING count(*) >= "
        f"ceil(CAST({MIN_SUPPORT} AS DOUBLE) * (SELECT count(*) FROM {{rows}}))"
    ),
    "artifact_catalog": """
        SELECT c_custkey, CAST(c_nationkey AS VARCHAR) AS model,
          CASE WHEN n_regionkey <= 1 THEN 'kmeans_' || c_nationkey END AS artifact,
          coalesce(n_regionkey <= 1, false) AS known
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "stream_ingest": f"""
        SELECT event_id, row_no, batch_no, {REMAINDER} AS is_remainder, {BATCH_LIST}
        FROM ({NUMBERED})""",
    "topic_ingest": f"SELECT event_id, batch_no, {BATCH_LIST} FROM ({NUMBERED})",
    "first_batches": f"SELECT event_id, batch_no FROM ({NUMBERED}) WHERE batch_no <= 2",
    "ingest_after_crash": f"""
        SELECT event_id, row_no, batch_no, {REMAINDER} AS is_remainder,
          event_id <= (SELECT max(event_id) // 2 FROM events) AS committed
        FROM ({NUMBERED})""",
}
ORACLES["refreshed_itemsets"] = ORACLES["trained_itemsets"]


def _snapshot_figures(feature: str) -> str:
    real = f"CASE WHEN isnan({feature}) THEN NULL ELSE {feature} END"
    fill = f"coalesce(avg({real}) OVER (), 0.0)" if feature == "Rating" else "CAST(0.0 AS DOUBLE)"
    filled = f"SELECT {real} AS x, {fill} AS fill, coalesce({real}, {fill}) AS v FROM {{rows}}"
    return (
        f"SELECT '{{name}}' AS snapshot, '{feature}' AS feature, count(*) AS row_count, count(*) - count(x) AS missing, "
        f"{_round('any_value(fill)')} AS fill, {_round('avg(v)')} AS mean, {_round('stddev_samp(v)')} AS deviation "
        f"FROM ({filled})"
    )


ORACLES["refreshed_statistics"] = " UNION ALL ".join(_per_snapshot(_snapshot_figures(c)) for c in FEATURES)
ORACLES["snapshot_report"] = f"""
    SELECT snapshot, count_if(tier <= n)::BIGINT AS rows_read, count_if(tier <= n)::BIGINT AS rows_kept,
      count_if(tier <= n) > 0 AS trained
    FROM (SELECT CASE WHEN length(App) <= 9 THEN 2 ELSE 3 END AS tier FROM ({APPS})),
      (VALUES ('model1', 1), ('model2', 2), ('model3', 3)) AS s(snapshot, n)
    GROUP BY 1"""
ORACLES["too_few_batches"] = f"""
    SELECT count(*) AS row_count, CAST(2 AS BIGINT) AS batches,
      '2 batches found; the cumulative snapshots need 3' AS said
    FROM events WHERE {DAMAGE} = 'good'"""
ORACLES["late_arrivals"] = f"""
    WITH d AS (SELECT *, event_type NOT IN ('click', 'error') AS later FROM events),
    latest AS (SELECT max(ts) AS t FROM d WHERE NOT later)
    SELECT event_id, row_number() OVER w AS row_no,
      CAST((row_number() OVER w - 1) // {EVENT_BATCH} + 1 AS BIGINT) AS batch_no,
      CASE WHEN later AND ts < t THEN round((epoch_us(t) - epoch_us(ts)) / 1e6, 3) END AS lateness
    FROM d, latest WHERE {DAMAGE} = 'good' WINDOW w AS (ORDER BY later, ts, event_id % 3, event_id)"""
ORACLES["score_stream"] = f"""
    SELECT delivery, model, status, count(*) AS requests, CAST(0 AS BIGINT) AS wrong
    FROM (SELECT CASE WHEN request_id > middle THEN 2 ELSE 1 END::BIGINT AS delivery,
        CASE WHEN o_orderstatus = 'P' AND o_totalprice >= 300000 THEN 'model9' ELSE model END AS model,
        CASE WHEN o_orderstatus = 'P' THEN 'unknown_model' WHEN request_id <= middle AND o_orderstatus = 'O' THEN 'unknown_model'
          ELSE status END AS status
      FROM ({REQUESTS}) JOIN orders ON request_id = o_orderkey, (SELECT max(o_orderkey) // 2 AS middle FROM orders))
    GROUP BY ALL"""
# A repaired export holds what a whole one holds, and a compacted store what the stream put there.
ORACLES["export_repair"] = ORACLES["batch_csv_roundtrip"]
ORACLES["compacted_ingest"] = ORACLES["stream_ingest"]
