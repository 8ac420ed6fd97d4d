"""SQL text of the table bindings, for the DuckDB oracles.

Each binding mirrors a function in ``cartwheel.sources.tables`` and is used
as a CTE prefix by the oracle queries.
"""

INTERACTIONS = """interactions AS (
  SELECT e.event_id, e.ts AS event_time,
         CASE WHEN e.event_type = 'click' THEN 'cart' ELSE e.event_type END AS event_type,
         TRY_CAST(json_extract_string(e.props, '$.k') AS INTEGER) AS product_id,
         e.value AS price, e.user_id,
         CAST(e.user_id AS VARCHAR) || '|' || CAST(CAST(e.ts AS DATE) AS VARCHAR) AS user_session,
         CASE WHEN p.p_size % 5 <> 0 THEN p.p_type END AS category_code, p.p_brand AS brand
  FROM events e
  LEFT JOIN part p ON p.p_partkey = TRY_CAST(json_extract_string(e.props, '$.k') AS INTEGER)
)"""

REVIEWS = """reviews AS (
  SELECT d.doc_id AS review_id, d.doc_id AS product_id, d.source AS brand_name,
         CASE WHEN d.n_chars >= 400 THEN split_part(d.text, chr(10), 1) END AS review_title, d.text AS review_text, d.lang,
         split_part(d.text, chr(10), 1) AS product_title,
         CAST(l.quality AS VARCHAR) AS product_rating, CAST(l.toxic AS VARCHAR) AS review_label,
         CAST(d.n_chars AS VARCHAR) AS product_rating_count, 
         CASE WHEN d.lang = 'de' THEN 'EUR ' || CAST(d.n_chars AS VARCHAR)
              ELSE CAST(d.n_chars // 100 AS VARCHAR) || '.' || lpad(CAST(d.n_chars % 100 AS VARCHAR), 2, '0') END AS price,
         CASE WHEN d.lang = 'fr' THEN 'n/a'
              ELSE CAST(DATE '2023-01-01' + CAST(d.doc_id % 365 AS INTEGER) AS VARCHAR) || ' 12:30:00' END AS review_date
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
)"""

MAPPING = """mapping AS (
  SELECT CAST(doc_id % 100 AS INTEGER) AS product_id_events, doc_id AS product_id_reviews
  FROM documents
)"""

PART_BASKETS = """baskets AS (
  SELECT l_orderkey AS basket, l_partkey AS item, l_quantity AS qty FROM lineitem
)"""

BRAND_BASKETS = """baskets AS (
  SELECT l.l_orderkey AS basket, p.p_brand AS item, l.l_quantity AS qty
  FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey
)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# ---- SQL twins of the text functions (DuckDB / RE2 syntax) ----
from cartwheel.functions.text import LEMMAS, STOP_WORDS, WS  # noqa: E402


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


STOP_LIST_SQL = "[" + ", ".join(_q(w) for w in STOP_WORDS) + "]"


def sql_clean_title(e: str) -> str:
    return (f"regexp_replace(regexp_replace(lower({e}), '^[{WS}]+|[{WS}]+$', '', 'g'), "
            f"'[^a-zA-Z0-9 ]', '', 'g')")


def sql_letter_tokens(e: str) -> str:
    return (f"list_filter(regexp_split_to_array(regexp_replace(lower({e}), '[^a-z{WS}]', '', 'g'), "
            f"'[{WS}]+'), lambda t: t <> '')")


def sql_clean_text_stop(e: str) -> str:
    return (f"array_to_string(list_filter({sql_letter_tokens(e)}, "
            f"lambda t: NOT list_contains({STOP_LIST_SQL}, t)), ' ')")


def sql_ws_tokens(e: str) -> str:
    return f"list_filter(regexp_split_to_array({e}, '[{WS}]+'), lambda t: t <> '')"


def sql_safe_text(e: str) -> str:
    return f"coalesce(nullif({e}, ''), '')"


def sql_stem3(e: str) -> str:
    return f"array_to_string(list_transform({sql_ws_tokens(sql_safe_text(e))}, lambda t: substr(t, 1, 3)), ' ')"


def sql_lemmatize(e: str) -> str:
    cases = " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in sorted(LEMMAS.items()))
    return (f"array_to_string(list_transform({sql_ws_tokens(sql_safe_text(e))}, "
            f"lambda t: CASE t {cases} ELSE t END), ' ')")
