"""Independent DuckDB formulations used as the correctness oracle.

Plain SQL over the pre-registered driver tables; written from the operator
definitions, not generated from the Spark plans.  Fragments are CTEs that
later queries stack.
"""

from sessionlab.constants import FEATURE_COLS

NP = "(event_type IS DISTINCT FROM 'purchase')"

SHOP_EVENTS = """
ev0 AS (
  SELECT event_id, ts, user_id, event_type AS raw_type, value,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k
  FROM events
),
ev1 AS (
  SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev_ts FROM ev0
),
ev2 AS (
  SELECT *, sum(CASE WHEN prev_ts IS NOT NULL AND epoch_us(ts) - epoch_us(prev_ts) > 43200000000
                     THEN 1 ELSE 0 END)
              OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS session_no
  FROM ev1
),
shop_events AS (
  SELECT ev2.event_id, ev2.ts AS event_time,
         CASE raw_type WHEN 'click' THEN 'cart' WHEN 'error' THEN 'remove_from_cart'
              WHEN 'purchase' THEN 'purchase' WHEN 'view' THEN 'view' WHEN 'signup' THEN 'view' END AS event_type,
         k AS product_id, k // 5 AS category_id,
         CASE WHEN ev2.event_id % 10 = 0 AND (k // 5) % 4 <> 3
              THEN lower(pc.p_type) || '.' || replace(pc.p_name, ' ', '.') END AS category_code,
         CASE WHEN ev2.event_id % 3 <> 0 THEN pp.p_brand END AS brand,
         CAST(value AS FLOAT) AS price, user_id,
         CASE WHEN ev2.event_id % 997 <> 0 THEN CAST(user_id AS VARCHAR) || '-' || CAST(session_no AS VARCHAR) END
           AS user_session,
         CAST(least(3, (day(ts) - 1) // 8) AS INTEGER) AS period
  FROM ev2 LEFT JOIN part pp ON pp.p_partkey = k LEFT JOIN part pc ON pc.p_partkey = k // 5
)"""

CATEGORY_MAP = """
cm AS (
  SELECT category_id, category_code FROM (
    SELECT category_id, category_code,
           row_number() OVER (PARTITION BY category_id
                              ORDER BY period DESC, epoch_us(event_time), event_id) AS rn
    FROM shop_events WHERE category_code IS NOT NULL) WHERE rn = 1
)"""

EVENTS_CAT = """
evc AS (
  SELECT e.*, cm.category_code AS category_filled, split_part(cm.category_code, '.', 1) AS main_cat
  FROM shop_events e LEFT JOIN cm USING (category_id)
)"""


def rollup(src: str, name: str, by: str = "") -> str:
    """Session rollup of ``src`` (events with main_cat) grouped by ``by`` +
    user_session, as CTE ``name``."""
    byc = f"{by}, " if by else ""
    part = f"{by}, " if by else ""
    return f"""
{name}_mc AS (
  SELECT {byc}user_session, main_cat FROM (
    SELECT {byc}user_session, main_cat,
           row_number() OVER (PARTITION BY {part}user_session ORDER BY count(*) DESC, main_cat) AS rn
    FROM {src} WHERE user_session IS NOT NULL AND main_cat IS NOT NULL
    GROUP BY {byc}user_session, main_cat) WHERE rn = 1
),
{name}_r AS (
  SELECT {byc}user_session,
    arg_min(user_id, row(CASE WHEN {NP} THEN -1 ELSE 0 END, epoch_us(event_time), event_id)) AS user_id,
    count(*) FILTER (WHERE {NP} AND event_type = 'view') AS n_view,
    count(*) FILTER (WHERE {NP} AND event_type = 'cart') AS n_cart,
    count(*) FILTER (WHERE {NP} AND event_type = 'remove_from_cart') AS n_remove,
    count(*) FILTER (WHERE {NP}) AS n_events,
    avg(CAST(price AS DOUBLE)) FILTER (WHERE {NP}) AS avg_price,
    max(CAST(price AS DOUBLE)) FILTER (WHERE {NP}) AS max_price,
    min(CAST(price AS DOUBLE)) FILTER (WHERE {NP}) AS min_price,
    stddev_samp(CAST(price AS DOUBLE)) FILTER (WHERE {NP}) AS price_std,
    count(DISTINCT product_id) FILTER (WHERE {NP}) AS unique_products,
    count(DISTINCT category_id) FILTER (WHERE {NP}) AS unique_categories,
    max(CASE WHEN brand IS NOT NULL THEN 1 ELSE 0 END) FILTER (WHERE {NP}) AS has_brand,
    (epoch_us(max(event_time) FILTER (WHERE {NP})) - epoch_us(min(event_time) FILTER (WHERE {NP}))) / 1e6
      AS session_duration_sec,
    max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS purchased
  FROM {src} WHERE user_session IS NOT NULL
  GROUP BY {byc}user_session
),
{name} AS (
  SELECT {', '.join('r.' + b.strip() for b in by.split(',')) + ', ' if by else ''}r.user_session,
    CAST(r.user_id AS BIGINT) AS user_id,
    CAST(r.n_view AS INTEGER) AS n_view, CAST(r.n_cart AS INTEGER) AS n_cart,
    CAST(r.n_remove AS INTEGER) AS n_remove, CAST(r.n_events AS INTEGER) AS n_events,
    CAST(coalesce(r.avg_price, 0) AS FLOAT) AS avg_price, CAST(coalesce(r.max_price, 0) AS FLOAT) AS max_price,
    CAST(coalesce(r.min_price, 0) AS FLOAT) AS min_price, CAST(coalesce(r.price_std, 0) AS FLOAT) AS price_std,
    CAST(r.unique_products AS INTEGER) AS unique_products, CAST(r.unique_categories AS INTEGER) AS unique_categories,
    CAST(coalesce(r.has_brand, 0) AS TINYINT) AS has_brand,
    CAST(coalesce(r.session_duration_sec, 0) AS FLOAT) AS session_duration_sec,
    CAST(r.purchased AS TINYINT) AS purchased, m.main_cat
  FROM {name}_r r LEFT JOIN {name}_mc m ON m.user_session = r.user_session {('AND ' + ' AND '.join(f'm.{b.strip()} = r.{b.strip()}' for b in by.split(','))) if by else ''}
)"""


SESSIONS = rollup("evc", "sess0") + """,
sessions_all AS (
  SELECT * FROM sess0 WHERE main_cat IS NULL OR main_cat NOT IN ('promo')
)"""

FEATURES = """
feats AS (
  SELECT *, CAST(CASE WHEN n_view > 0 THEN n_cart / n_view ELSE 0.0 END AS FLOAT) AS cart_to_view_ratio,
         CAST(n_remove / greatest(n_cart, 1) AS FLOAT) AS remove_to_cart_ratio
  FROM sessions_all
),
feats_cat AS (SELECT * FROM feats WHERE main_cat IS NOT NULL)"""

SESSION_COLS = ("user_session, user_id, n_view, n_cart, n_remove, n_events, avg_price, max_price, min_price, "
                "price_std, unique_products, unique_categories, has_brand, session_duration_sec, purchased, main_cat")


def long_form(src: str, name: str, features=FEATURE_COLS, keep: str = "") -> str:
    k = f"{keep}, " if keep else ""
    parts = " UNION ALL ".join(f"SELECT {k}'{f}' AS feature, CAST({f} AS DOUBLE) AS x FROM {src}" for f in features)
    return f"\n{name} AS ({parts})"


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


BASE = (SHOP_EVENTS, CATEGORY_MAP, EVENTS_CAT, SESSIONS)
BASE_F = BASE + (FEATURES,)
