"""Shared parts of the SQL meanings (ANSI SQL as DuckDB reads it)."""

GRID = """grid AS (SELECT CAST(g AS DATE) AS pred_dt
  FROM generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-07-01', INTERVAL 6 MONTH) t(g))"""
ORD = """ord AS (SELECT o_orderkey, o_custkey AS ent, CAST(o_orderdate AS DATE) AS dt,
  o_orderstatus AS status, o_orderpriority AS priority, o_totalprice AS price FROM orders)"""
SPAN = """span AS (SELECT ent, MIN(dt) AS enrollment_start, MAX(dt) AS enrollment_end FROM ord GROUP BY ent)"""
SPINE = """spine AS (SELECT ent, enrollment_start, enrollment_end, pred_dt FROM span
  JOIN grid ON pred_dt BETWEEN enrollment_start AND enrollment_end)"""
BASE = f"{GRID}, {ORD}, {SPAN}, {SPINE}"
ITEMS = """items AS (SELECT ent, CAST(l_shipdate AS DATE) AS dt, l_returnflag AS code, l_linestatus AS ls,
  l_quantity AS qty, l_partkey, l_orderkey, l_linenumber FROM lineitem JOIN ord ON l_orderkey = o_orderkey)"""
DAYS = """days AS (SELECT s.ent, s.pred_dt,
  COUNT(DISTINCT i.dt) FILTER (WHERE i.code = 'A') AS days_a,
  COUNT(DISTINCT i.dt) FILTER (WHERE i.code = 'N') AS days_n,
  COUNT(DISTINCT i.dt) FILTER (WHERE i.code = 'R') AS days_r
  FROM spine s LEFT JOIN items i ON s.ent = i.ent
    AND i.dt BETWEEN s.pred_dt - INTERVAL 6 MONTH AND s.pred_dt
  GROUP BY s.ent, s.pred_dt)"""
SPELLS = """raw AS (SELECT o_orderkey, ent, dt AS start_date,
  CASE WHEN status <> 'O' THEN dt + 120 END AS end_date FROM ord),
norm AS (SELECT *,
  CASE WHEN month(start_date) IN (8, 9) THEN make_date(year(start_date), 8, 1) ELSE start_date END AS calendar_start,
  CASE WHEN end_date IS NULL THEN make_date(year(start_date) + 1, 7, 31)
       WHEN month(end_date) IN (5, 6) THEN make_date(year(end_date), 7, 31)
       ELSE end_date END AS calendar_end
  FROM raw)"""
ISLANDS = """marked AS (SELECT *, MAX(calendar_end) OVER (PARTITION BY ent ORDER BY calendar_start, o_orderkey
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM norm),
numbered AS (SELECT *, SUM(CASE WHEN reach IS NULL OR calendar_start > reach + 1 THEN 1 ELSE 0 END)
    OVER (PARTITION BY ent ORDER BY calendar_start, o_orderkey) AS island FROM marked),
merged AS (SELECT ent, MIN(start_date) AS enrollment_start,
  CASE WHEN COUNT(*) > COUNT(end_date) THEN MAX(calendar_end) ELSE MAX(end_date) END AS enrollment_end
  FROM numbered GROUP BY ent, island)"""
FIRST = """firsts AS (SELECT o.ent, MIN(o.dt) AS condition_start FROM ord o JOIN span s ON o.ent = s.ent
  WHERE o.priority = '1-URGENT' AND o.dt > s.enrollment_start + 365 GROUP BY o.ent)"""


def labelled(horizon: int = 6, unresolved: bool = False) -> str:
    lower = "" if unresolved else "AND condition_start > pred_dt"
    return f"""{FIRST}, labelled AS (SELECT s.ent, s.pred_dt, s.enrollment_start, condition_start,
  CASE WHEN condition_start <= s.pred_dt + INTERVAL {horizon} MONTH {lower} THEN 1 ELSE 0 END AS label,
  CASE WHEN condition_start < s.pred_dt THEN 1 ELSE 0 END AS prior
  FROM spine s LEFT JOIN firsts f ON s.ent = f.ent)"""


SCORED = f"""{BASE}, {ITEMS}, {DAYS}, {labelled()}, scored AS (SELECT l.ent, l.pred_dt, l.label, days_a, days_n, days_r,
  COALESCE(CAST(days_a AS DOUBLE) / NULLIF(days_a + days_n + days_r, 0), 0) AS score
  FROM labelled l JOIN days d ON l.ent = d.ent AND l.pred_dt = d.pred_dt)"""
DOCS = """docs AS (SELECT l.doc_id, d.lang, d.source, d.n_chars, l.quality AS label, l.toxic,
  CAST(d.n_chars % 997 AS DOUBLE) / 997 AS score FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""


def curve(source: str, keys: str) -> str:
    """Cells at every distinct score of ``source`` per ``keys``."""
    k = f"{keys}, " if keys else ""
    part = f"PARTITION BY {keys}" if keys else ""
    return f"""cnt AS (SELECT {k}score AS threshold, COUNT(*) FILTER (WHERE label = 1) AS pos,
    COUNT(*) FILTER (WHERE label = 0) AS neg FROM {source} GROUP BY {k}score),
curve AS (SELECT *, CAST(SUM(pos) OVER (u) AS BIGINT) AS tp, CAST(SUM(neg) OVER (u) AS BIGINT) AS fp,
    CAST(SUM(pos) OVER (w) AS BIGINT) AS p, CAST(SUM(neg) OVER (w) AS BIGINT) AS n
  FROM cnt WINDOW u AS ({part} ORDER BY threshold DESC), w AS ({part}))"""
