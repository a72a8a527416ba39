"""The same results stated in plain SQL over the same tables.

Nothing of the cleaning is repeated here: what the messy text must turn into
is stated from the clean columns and from the rule that broke the row.
"""

from __future__ import annotations

FACT = """
fact AS (
  SELECT l_orderkey AS order_id, l_linenumber AS line_number, o_custkey AS customer_id,
         CAST(o_orderdate AS DATE) AS order_date, CAST(l_shipdate AS DATE) AS ship_date,
         CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start,
         year(o_orderdate) AS year, month(o_orderdate) AS month,
         CAST(l_quantity AS INT) AS quantity, CAST(l_discount AS DECIMAL(18,4)) AS discount,
         CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,4)) AS sales,
         CAST(l_extendedprice * (0.05 - l_discount) AS DECIMAL(18,4)) AS profit,
         p_type AS category, p_brand AS sub_category, n_name AS country, r_name AS region,
         (l_orderkey + l_linenumber) % 388 AS fault
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN part ON l_partkey = p_partkey
  LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN region ON n_regionkey = r_regionkey
), good AS (SELECT * FROM fact WHERE sales > 0)
"""

# What cleaning must give for each raw row.
CLEAN = """
, clean AS (
  SELECT *, CASE WHEN fault IN (0, 1) THEN NULL WHEN fault = 3 THEN 0 ELSE sales END AS sales_clean,
         CASE WHEN fault <> 2 THEN order_date END AS date_clean
  FROM fact
), kept AS (SELECT * FROM clean WHERE date_clean IS NOT NULL AND sales_clean > 0)
"""


def _iso(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d')"


def _total(column: str = "sales") -> str:
    return f"CAST(sum({column}) AS DOUBLE)"


def _series(*dims: str, where: str = "true") -> str:
    keys = "".join(f", {d}" for d in dims)
    return f""", series AS (
  SELECT month_start AS date, year, month{keys}, sum(sales) AS revenue
  FROM good WHERE {where} GROUP BY month_start, year, month{keys})
"""


def _filled(*dims: str, source: str = "series") -> str:
    """Each key's months from its first to its last, zero where it has no row."""
    keys = "".join(f", {d}" for d in dims)
    group = f"GROUP BY {', '.join(dims)}" if dims else ""
    same = "".join(f" AND s.{d} = m.{d}" for d in dims)
    named = "".join(f", m.{d}" for d in dims)
    return f""", months AS (
  SELECT CAST(unnest(generate_series(CAST(min(date) AS TIMESTAMP), CAST(max(date) AS TIMESTAMP),
         INTERVAL 1 MONTH)) AS DATE) AS date{keys} FROM {source} {group}
), filled AS (
  SELECT m.date, year(m.date) AS year, month(m.date) AS month{named}, coalesce(s.revenue, 0) AS revenue
  FROM months m LEFT JOIN {source} s ON s.date = m.date{same})
"""


def _with(*parts: str) -> str:
    return "WITH " + FACT + "".join(parts)


def _period_rows(source: str, *dims: str) -> str:
    keys = "".join(f", {d}" for d in dims)
    return (
        f"SELECT {_iso('date')} AS date, year, month{keys}, CAST(revenue AS DOUBLE) AS revenue "
        f"FROM {source}"
    )


def _monthly(*dims: str) -> str:
    keys = "".join(f", {d}" for d in dims)
    return _with(
        f"SELECT year, month{keys}, {_total()} AS total_sales FROM good GROUP BY year, month{keys}"
    )


def _by(dim: str, tail: str = "") -> str:
    return _with(f"SELECT {dim}, {_total()} AS revenue FROM good GROUP BY {dim} {tail}")


def _changes(*dims: str) -> str:
    keys = "".join(f", {d}" for d in dims)
    part = f"PARTITION BY {', '.join(dims)}" if dims else ""
    return f""", lagged AS (
  SELECT *, lag(revenue, 1) OVER ({part} ORDER BY date) AS prev,
         lag(revenue, 12) OVER ({part} ORDER BY date) AS last_year,
         sum(revenue) OVER (PARTITION BY {"".join(d + ", " for d in dims)} year ORDER BY date
                            ROWS UNBOUNDED PRECEDING) AS ytd
  FROM filled
), changes AS (
  SELECT date, year, month{keys}, CAST(revenue AS DOUBLE) AS revenue, CAST(prev AS DOUBLE) AS prev,
         CAST(last_year AS DOUBLE) AS last_year, CAST(ytd AS DOUBLE) AS ytd,
         CASE WHEN prev <> 0 THEN CAST(revenue - prev AS DOUBLE) / CAST(prev AS DOUBLE) * 100 END AS mom,
         CASE WHEN last_year <> 0 THEN
           CAST(revenue - last_year AS DOUBLE) / CAST(last_year AS DOUBLE) * 100 END AS yoy
  FROM lagged)
"""


def _changes_result(*dims: str) -> str:
    keys = "".join(f", {d}" for d in dims)
    return _with(
        _series(*dims),
        _filled(*dims),
        _changes(*dims),
        f"SELECT {_iso('date')} AS date, year, month{keys}, revenue, prev, last_year, ytd, "
        "round(mom, 6) AS mom, round(yoy, 6) AS yoy FROM changes",
    )


def _band(*dims: str, frame: str = "5 PRECEDING AND CURRENT ROW") -> str:
    part = f"PARTITION BY {', '.join(dims)}" if dims else ""
    over = f"OVER ({part} ORDER BY date ROWS BETWEEN {frame})"
    return f""", amounts AS (SELECT * REPLACE (CAST(revenue AS DOUBLE) AS revenue) FROM filled
), rolled AS (
  SELECT *, CASE WHEN count(*) {over} >= 3 THEN avg(revenue) {over} END AS ma,
         CASE WHEN count(*) {over} >= 3 THEN stddev_samp(revenue) {over} END AS std
  FROM amounts
), band AS (
  SELECT *, CASE WHEN std <> 0 THEN (revenue - ma) / std END AS z,
         coalesce(CASE WHEN std <> 0 THEN abs((revenue - ma) / std) END >= 2.0, false) AS anomaly
  FROM rolled)
"""


def _band_result(*dims: str) -> str:
    keys = "".join(f", {d}" for d in dims)
    return _with(
        _series(*dims),
        _filled(*dims),
        _band(*dims),
        f"SELECT {_iso('date')} AS date, year, month{keys}, revenue, round(ma, 2) AS ma, "
        "round(std, 2) AS std, round(z, 6) AS z, anomaly, "
        "round(CASE WHEN ma - std < 0 THEN 0 ELSE ma - std END, 2) AS band_low, "
        "round(ma + std, 2) AS band_high FROM band",
    )


LATEST = ", latest AS (SELECT * FROM series WHERE date = (SELECT max(date) FROM series))"

OVERLAY = """, tail AS (
  SELECT *, row_number() OVER (ORDER BY date DESC) AS back FROM filled
), overlay AS (
  SELECT CASE WHEN back <= 12 THEN 'Last 12M' ELSE 'Prev 12M' END AS series,
         (24 - back) % 12 AS pos, date, CAST(revenue AS DOUBLE) AS revenue
  FROM tail WHERE back <= 24 AND (SELECT count(*) FROM filled) >= 24)
"""


def _pareto(dim: str) -> str:
    return f""", by_value AS (
  SELECT date, {dim}, sum(revenue) AS revenue FROM latest GROUP BY date, {dim}
), shares AS (
  SELECT date, {dim}, CAST(revenue AS DOUBLE) AS revenue,
         CAST(sum(revenue) OVER w AS DOUBLE) / CAST(sum(revenue) OVER () AS DOUBLE) AS cum_share
  FROM by_value WINDOW w AS (ORDER BY revenue DESC, {dim} ROWS UNBOUNDED PRECEDING)
), pareto AS (SELECT * FROM shares ORDER BY revenue DESC, {dim} LIMIT 15)
"""


def _ranked(dim: str) -> str:
    return f""", ranked AS (
  SELECT {dim}, row_number() OVER (ORDER BY sum(revenue) DESC, {dim}) AS rank
  FROM series GROUP BY {dim} QUALIFY rank <= 8
), top_series AS (
  SELECT d.date, r.rank, r.{dim}, coalesce(CAST(sum(s.revenue) AS DOUBLE), 0) AS revenue
  FROM (SELECT DISTINCT date FROM series) d CROSS JOIN ranked r
  LEFT JOIN series s ON s.date = d.date AND s.{dim} = r.{dim}
  GROUP BY d.date, r.rank, r.{dim})
"""


def _money(x: str) -> str:
    return (
        f"CASE WHEN {x} IS NULL THEN '-' WHEN abs({x}) >= 1e6 THEN printf('$%.2fM', {x} / 1e6) "
        f"WHEN abs({x}) >= 1e3 THEN printf('$%.1fK', {x} / 1e3) ELSE printf('$%.0f', {x}) END"
    )


def _percent(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN '-' ELSE printf('%+.1f%%', {x}) END"


def _renamed(order: str, line: str, country: str, quantity: str) -> str:
    return _with(
        f"""SELECT CAST(order_id AS VARCHAR) AS "{order}", CAST(line_number AS VARCHAR) AS "{line}",
        country AS "{country}",
        CASE line_number % 3 WHEN 0 THEN quantity || '' WHEN 1 THEN ' ' || quantity || ' '
             ELSE quantity || '.0' END AS "{quantity}" FROM fact"""
    )


def _filled_counts(*names: str) -> str:
    columns = (
        "order_id", "line_number", "coalesce(order_date, DATE '2000-01-01')", "ship_date",
        "coalesce(sales, 0)", "profit", "discount", "quantity", "category", "country", "year",
    )
    return _with("SELECT " + ", ".join(f'count({c}) AS "{n}"' for c, n in zip(columns, names)) + " FROM fact")


def _profile() -> str:
    numeric = {
        "line_number": "int", "quantity": "int", "discount": "decimal(18,4)",
        "sales": "decimal(18,4)", "profit": "decimal(18,4)",
        "order_id": "bigint", "customer_id": "bigint", "year": "int", "month": "int",
    }
    shown = {c: f"{c}_clean" for c in ("quantity", "discount", "sales", "profit")}
    rows = [
        f"SELECT '{shown.get(c, c)}' AS column, '{kind}' AS dtype, count(*) AS rows, "
        f"count(*) - count({c}) AS nulls, round(avg(CAST({c} AS DOUBLE)), 2) AS mean, "
        f"round(stddev_samp(CAST({c} AS DOUBLE)), 2) AS std, "
        f"round(CAST(min({c}) AS DOUBLE), 2) AS min, round(CAST(max({c}) AS DOUBLE), 2) AS max FROM fact"
        for c, kind in numeric.items()
    ]
    rows.append(
        "SELECT 'category', 'string', count(*), count(*) - count(category), NULL, NULL, NULL, NULL FROM fact"
    )
    return _with(" UNION ALL ".join(rows))


def _null_rates() -> str:
    nulls = {
        "order_id": "0", "line_number": "0", "order_date": "count_if(fault = 2)", "ship_date": "0",
        "sales": "0", "profit": "0", "discount": "0", "quantity": "0", "category": "0",
        "country_market": "0", "year": "0", "sales_clean": "count_if(fault IN (0, 1))",
        "profit_clean": "0", "discount_clean": "0", "quantity_clean": "0",
    }
    rows = [
        f"SELECT '{c}' AS column, count(*) AS rows, CAST({n} AS BIGINT) AS nulls, "
        f"round(CAST({n} AS DOUBLE) / count(*), 6) AS null_rate FROM fact"
        for c, n in nulls.items()
    ]
    return _with(" UNION ALL ".join(rows))


def _quality_report() -> str:
    columns = [
        ("o_orderkey", "bigint", "bigint", "same"),
        ("o_custkey", "bigint", "bigint", "same"),
        ("o_orderstatus", "string", "string", "same"),
        ("o_totalprice", "decimal(18,4)", "double", "type_changed"),
        ("o_orderdate", "timestamp_ntz", "timestamp_ntz", "same"),
        ("o_clerk", "string", None, "missing"),
        ("o_orderpriority", None, "string", "added"),
    ]

    def text(value: str | None) -> str:
        return "NULL" if value is None else f"'{value}'"

    rows = []
    for name, expected, actual, status in columns:
        nulls = "NULL" if actual is None else f"count(*) - count({name})"
        count = "NULL" if actual is None else "count(*)"
        rows.append(
            f"SELECT '{name}' AS column, {text(expected)} AS expected_type, "
            f"{text(actual)} AS actual_type, '{status}' AS status, {count} AS rows, "
            f"{nulls} AS nulls, round(CAST({nulls} AS DOUBLE) / {count}, 6) AS null_rate "
            f"FROM (SELECT * FROM orders{'' if actual else ' LIMIT 1'})"
        )
    return " UNION ALL ".join(rows)


def _quoted(accent: str) -> str:
    return _with(
        "SELECT CAST(order_id AS VARCHAR) AS order_id, "
        f"sub_category || ', 3\" ' || category || ' \"{accent}\"' AS product_name, "
        "CAST(sales AS DOUBLE) AS sales FROM fact"
    )


REASON = """CASE fault WHEN 2 THEN 'missing_order_date' WHEN 3 THEN 'non_positive_sales'
            ELSE 'missing_sales' END"""
RAW_SALES = "CASE fault WHEN 0 THEN '  ' WHEN 1 THEN 'n/a' WHEN 3 THEN '$0.00' END"

SILVER_GOLD = _with(
    CLEAN,
    f"SELECT year, month, lower(category) AS category, {_total('sales_clean')} AS total_sales "
    "FROM kept GROUP BY year, month, lower(category)",
)

CARD = ", card AS (SELECT * FROM changes ORDER BY date DESC LIMIT 1)"

TOP3 = """, top3 AS (
  SELECT category, CAST(revenue AS DOUBLE) AS revenue FROM
    (SELECT category, sum(revenue) AS revenue FROM latest GROUP BY category)
  ORDER BY revenue DESC, category LIMIT 3)
"""

ALL_DAYS = """
    SELECT strftime(ts, '%Y-%m-%d') AS day, event_type,
           CAST(sum(CAST(value AS DECIMAL(18,4))) AS DOUBLE) AS revenue, count(*) AS events
    FROM events GROUP BY 1, 2"""

ORACLES: dict[str, str] = {
    "normalize_columns": _renamed("order_id", "line_number", "country_market", "quantity"),
    "normalize_columns_strict": _renamed("order_id", "line_number", "country_market", "_quantity_"),
    "normalize_columns_lower": _renamed("order id", "line.number", "country/market", "[quantity]"),
    "normalize_all_columns": _filled_counts(
        "order_id", "line_number", "order_date", "ship_date", "sales", "profit", "discount",
        "quantity", "category", "country_market", "year",
    ),
    "normalize_all_columns_strict": _filled_counts(
        "order_id", "line_number", "order_date", "ship_date", "sales", "profit", "discount",
        "_quantity_", "category", "country_market", "year",
    ),
    "normalize_all_columns_lower": _filled_counts(
        "order id", "line.number", "order date", "ship-date", "sales", "profit", "discount",
        "[quantity]", "category", "country/market", "year",
    ),
    "clean_money": _with(
        CLEAN,
        "SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(line_number AS VARCHAR) AS line_number, "
        "CAST(sales_clean AS DOUBLE) AS sales_clean, CAST(profit AS DOUBLE) AS profit_clean, "
        "CAST(discount AS DOUBLE) AS discount_clean FROM clean",
    ),
    "canonical_columns": _with(
        CLEAN,
        f"SELECT CAST(order_id AS VARCHAR) AS order_id, {_iso('date_clean')} AS order_date, "
        "CAST(sales_clean AS DOUBLE) AS sales_clean, quantity AS quantity_clean FROM clean",
    ),
    "clean_quantity": _with(
        "SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(line_number AS VARCHAR) AS line_number, "
        "quantity AS quantity_clean FROM fact"
    ),
    "parse_dates": _with(
        CLEAN,
        "SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(line_number AS VARCHAR) AS line_number, "
        f"{_iso('date_clean')} AS order_date, {_iso('ship_date')} AS ship_date FROM clean",
    ),
    "parse_dates_mixed": """
      WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, o_orderkey % 7 AS kind FROM orders)
      SELECT o_orderkey,
        CASE kind WHEN 0 THEN strftime(d, '%Y-%m-%d') WHEN 1 THEN strftime(d, '%-m/%-d/%Y 0:00')
          WHEN 2 THEN strftime(d, '%d-%m-%Y') WHEN 3 THEN strftime(d, '%-d-%b-%Y')
          WHEN 4 THEN strftime(d, '%-m/%-d/%y') WHEN 5 THEN strftime(d, '%Y')
          ELSE lpad(CAST(dayofyear(d) AS VARCHAR), 5, '3') END AS spelt,
        CASE WHEN kind = 4 THEN strftime(make_date(2000 + year(d) % 100, month(d), day(d)), '%Y-%m-%d')
          WHEN kind < 4 THEN strftime(d, '%Y-%m-%d') END AS parsed
      FROM o""",
    "standardize_dims": _with(
        "SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(line_number AS VARCHAR) AS line_number, "
        "lower(category) AS category, lower(country) AS country_market FROM fact"
    ),
    "good_rows": _with(
        CLEAN,
        "SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(line_number AS VARCHAR) AS line_number, "
        f"{_iso('order_date')} AS order_date, lower(category) AS category, "
        "CAST(sales_clean AS DOUBLE) AS sales_clean, quantity AS quantity_clean, year, month, "
        "CAST(year AS VARCHAR) AS src_year FROM kept",
    ),
    "quarantine_rows": _with(
        "SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(line_number AS VARCHAR) AS line_number, "
        f"CASE WHEN fault <> 2 THEN {_iso('order_date')} END AS order_date, "
        f"coalesce({RAW_SALES}, CASE line_number % 4 WHEN 0 THEN ' $' || x || ' ' WHEN 1 THEN '₹' || x "
        "WHEN 2 THEN '€ ' || x ELSE x || ' £' END) AS sales, "
        f"{REASON} AS reject_reasons "
        "FROM (SELECT *, format('{:,}', CAST(trunc(sales) AS BIGINT)) || "
        "right(CAST(sales AS VARCHAR), 5) AS x FROM fact WHERE fault < 4)",
    ),
    "except_all": _with(
        CLEAN,
        "SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(line_number AS VARCHAR) AS line_number, "
        f"{_iso('date_clean')} AS order_date, CAST(sales_clean AS DOUBLE) AS sales_clean "
        "FROM clean WHERE fault < 4",
    ),
    "quality_metrics": _with(
        CLEAN,
        "SELECT count(*) AS row_in, count_if(fault >= 4) AS row_good, count_if(fault < 4) AS row_bad, "
        "round(count_if(fault < 4) / count(*), 6) AS bad_fraction, "
        "count_if(fault < 4) / count(*) <= 0.05 AS gate_passed FROM clean",
    ),
    "reject_reason_counts": _with(
        f"SELECT {REASON} AS reason, count(*) AS rows FROM fact WHERE fault < 4 GROUP BY 1"
    ),
    "profile_columns": _profile(),
    "profile_quartiles": " UNION ALL ".join(
        f"SELECT '{c}' AS column, quantile_cont(CAST({c} AS DOUBLE), 0.25) AS p25, "
        f"quantile_cont(CAST({c} AS DOUBLE), 0.5) AS p50, "
        f"quantile_cont(CAST({c} AS DOUBLE), 0.75) AS p75 FROM lineitem"
        for c in (
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
            "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        )
    ),
    "null_rates": _null_rates(),
    "schema_drift": _quality_report(),
    "preview_rows": _with(
        f"SELECT {_iso('order_date')} AS order_date, order_id, line_number, "
        "CAST(sales AS DOUBLE) AS sales_clean FROM good ORDER BY 1, 2, 3, sales LIMIT 5"
    ),
    "bronze_csv_scan": _quoted("记录数"),
    "bronze_latin1_scan": _quoted("café"),
    "silver_roundtrip": _with(
        f"SELECT {_iso('order_date')} AS order_date, CAST(sales AS DOUBLE) AS sales_clean, year, month "
        "FROM good WHERE order_date >= DATE '1996-07-01' AND order_date < DATE '1999-07-01'"
    ),
    "silver_csv_roundtrip": _with(
        f"SELECT order_id, {_iso('order_date')} AS order_date, CAST(sales AS DOUBLE) AS sales_clean FROM good"
    ),
    "gold_csv_roundtrip": _monthly(),
    "month_csv_roundtrip": _with(
        f"SELECT {_iso('month_start')} AS month, {_total()} AS sales FROM good GROUP BY month_start"
    ),
    "batch_pipeline_gold": SILVER_GOLD,
    "batch_pipeline_audit": _with(
        CLEAN,
        "SELECT 'retail_batch' AS job_name, 'SUCCEEDED' AS status, count(*) AS row_in, "
        "count_if(fault >= 4) AS row_good, count_if(fault < 4) AS row_bad, "
        "round(count_if(fault < 4) / count(*), 6) AS bad_fraction FROM clean",
    ),
    "batch_pipeline_quarantine": _with(
        "SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(line_number AS VARCHAR) AS line_number, "
        f"coalesce({RAW_SALES}, CASE line_number % 4 WHEN 0 THEN ' $' || x || ' ' WHEN 1 THEN '₹' || x "
        "WHEN 2 THEN '€ ' || x ELSE x || ' £' END) AS sales, "
        f"{REASON} AS reject_reasons "
        "FROM (SELECT *, format('{:,}', CAST(trunc(sales) AS BIGINT)) || "
        "right(CAST(sales AS VARCHAR), 5) AS x FROM fact WHERE fault < 4)",
    ),
    "sql_over_gold": _with(
        CLEAN,
        f"SELECT year, {_total('sales_clean')} AS total_sales, count(DISTINCT month) AS months "
        "FROM kept GROUP BY year",
    ),
    "incremental_ingest": SILVER_GOLD,
    "mixed_header_ingest": SILVER_GOLD,
    "ingest_redelivered_file": _with(
        CLEAN,
        f"SELECT year, month, {_total('sales_clean')} AS total_sales FROM (SELECT *, row_number() OVER ("
        "PARTITION BY order_id, line_number ORDER BY sales_clean DESC) AS n FROM kept) "
        "WHERE n = 1 GROUP BY year, month",
    ),
    "ingest_corrected_rows": _with(
        CLEAN,
        f"SELECT year, month, {_total('sales_clean')} AS total_sales FROM ("
        "SELECT year, month, sales_clean FROM (SELECT *, row_number() OVER ("
        "PARTITION BY order_id, line_number ORDER BY sales_clean DESC) AS n FROM kept) "
        "WHERE n = 1 AND (order_id + line_number) % 7 <> 3 UNION ALL "
        "SELECT year, month, sales_clean FROM (SELECT DISTINCT order_id, line_number, year, "
        "CAST(7 AS BIGINT) AS month, CAST(line_number + 0.5 AS DECIMAL(18,4)) AS sales_clean FROM fact "
        "WHERE (order_id + line_number) % 7 = 3)) GROUP BY year, month",
    ),
    "audit_after_replay": _with(
        CLEAN,
        "SELECT 'again' AS run_id, 'SUCCEEDED' AS status, count(*) AS row_in, "
        "count_if(fault >= 4) AS row_good, CAST(0 AS BIGINT) AS row_duplicate FROM clean",
    ),
    "batch_pipeline_aborted": _with(
        CLEAN,
        "SELECT 'stopped' AS run_id, 'ABORTED' AS status, count_if(fault < 4) AS row_bad, "
        "count_if(fault < 4) AS quarantined, false AS silver FROM clean",
    ),
    "monthly_revenue": _monthly(),
    "monthly_revenue_by_category": _monthly("category"),
    "monthly_revenue_by_region": _monthly("region"),
    "monthly_revenue_by_country": _monthly("country"),
    "monthly_revenue_date": _with(
        f"SELECT {_iso('month_start')} AS month, {_total()} AS sales FROM good GROUP BY month_start"
    ),
    "revenue_by_country": _by("country"),
    "margin_rows": _with(
        "SELECT order_id, line_number, CAST(sales AS DOUBLE) AS sales_clean, "
        "CAST(profit AS DOUBLE) AS profit_clean, "
        "round(CAST(profit AS DOUBLE) / CAST(sales AS DOUBLE), 6) AS profit_margin FROM good"
    ),
    "kpi_totals": _with(
        f"SELECT {_total()} AS total_sales, {_total('profit')} AS total_profit, "
        f"round({_total('profit')} / {_total()}, 6) AS profit_margin FROM good"
    ),
    "display_labels": _with(
        f""", totals AS (
          SELECT country, sub_category, {_total()} AS revenue, {_total('profit')} / {_total()} * 100 AS margin
          FROM good GROUP BY country, sub_category) """,
        f"SELECT country, sub_category, {_money('revenue')} AS revenue, {_percent('margin')} AS margin "
        "FROM totals",
    ),
    "top_categories": _by("category", "ORDER BY revenue DESC, category LIMIT 5"),
    "top_categories_latest": _with(
        _series("country"),
        LATEST,
        f"SELECT {_iso('date')} AS date, country, CAST(revenue AS DOUBLE) AS revenue FROM latest "
        "ORDER BY revenue DESC, country LIMIT 10",
    ),
    "latest_totals": _with(
        _series("category", "region"),
        LATEST,
        f"SELECT {_iso('date')} AS date, category, {_total('revenue')} AS revenue "
        "FROM latest GROUP BY date, category",
    ),
    "top3_latest": _with(
        _series("category", "region"),
        LATEST,
        f"SELECT {_iso('date')} AS date, category, {_total('revenue')} AS revenue "
        "FROM latest GROUP BY date, category ORDER BY revenue DESC, category LIMIT 3",
    ),
    "sales_by_region": _by("region"),
    "category_share": _with(
        f"SELECT category, {_total()} AS revenue, "
        f"round({_total()} / (SELECT {_total()} FROM good), 6) AS share FROM good GROUP BY category"
    ),
    "top_customers": _by("customer_id", "ORDER BY revenue DESC, customer_id LIMIT 10"),
    "pareto_latest": _with(
        _series("country"),
        LATEST,
        _pareto("country"),
        f"SELECT {_iso('date')} AS date, country, revenue, round(cum_share, 6) AS cum_share FROM pareto",
    ),
    "category_pivot": _with(
        f"SELECT {_iso('month_start')} AS date, "
        + ", ".join(
            f"coalesce(CAST(sum(sales) FILTER (category = '{v}') AS DOUBLE), 0) AS \"{v}\""
            for v in ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
        )
        + ", coalesce(CAST(sum(sales) FILTER (category IS NULL OR category NOT IN "
        "('ECONOMY', 'LARGE', 'MEDIUM', 'PROMO', 'SMALL', 'STANDARD')) AS DOUBLE), 0) AS other"
        + " FROM good GROUP BY month_start"
    ),
    "category_pivot_all": _with(
        f"SELECT {_iso('month_start')} AS date, "
        + ", ".join(
            f"coalesce(CAST(sum(sales) FILTER (category = '{v}') AS DOUBLE), 0) AS \"{v}\""
            for v in ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
        )
        + ", coalesce(CAST(sum(sales) FILTER (category IS NULL) AS DOUBLE), 0) AS other, "
        "CAST(sum(sales) AS DOUBLE) AS total FROM good GROUP BY month_start"
    ),
    "category_pivot_top8": _with(
        _series("country"),
        _ranked("country"),
        f"SELECT {_iso('date')} AS date, "
        + ", ".join(f"sum(revenue) FILTER (rank = {k}) AS rank_{k}" for k in range(1, 9))
        + " FROM top_series GROUP BY date",
    ),
    "category_series_top8": _with(
        _series("country"),
        _ranked("country"),
        f"SELECT {_iso('date')} AS date, rank, country, revenue FROM top_series",
    ),
    "gap_filled_months": _with(
        _series("category", "sub_category", "country"),
        _filled("category", "sub_category", "country"),
        _period_rows("filled", "category", "sub_category", "country"),
    ),
    "calendar_join": _with(
        _series("sub_category", "country"),
        """, months AS (SELECT DISTINCT month_start AS date FROM good),
        keys AS (SELECT DISTINCT sub_category, country FROM series), filled AS (
        SELECT m.date, year(m.date) AS year, month(m.date) AS month, k.sub_category, k.country,
          coalesce(revenue, 0) AS revenue
        FROM keys k CROSS JOIN months m LEFT JOIN series s ON m.date = s.date
          AND s.sub_category IS NOT DISTINCT FROM k.sub_category AND s.country IS NOT DISTINCT FROM k.country) """,
        _period_rows("filled", "sub_category", "country"),
    ),
    "gap_filled_by_category": _with(
        _series("sub_category", "country"),
        _filled("sub_category", "country"),
        _period_rows("filled", "sub_category", "country"),
    ),
    "mom_yoy_ytd": _changes_result(),
    "mom_yoy_ytd_by_country": _changes_result("country"),
    "rolling_band": _band_result(),
    "rolling_band_by_category": _band_result("category"),
    "anomaly_flags": _with(
        _series("category"),
        _filled("category"),
        _band("category", frame="6 PRECEDING AND 1 PRECEDING"),
        f"SELECT {_iso('date')} AS date, category, revenue, round(z, 6) AS z, anomaly FROM band",
    ),
    "anomaly_list": _with(
        _series("category"),
        _filled("category"),
        _band("category"),
        f"SELECT {_iso('date')} AS date, category, revenue, round(ma, 2) AS ma, round(z, 6) AS z "
        "FROM band WHERE anomaly AND ma IS NOT NULL",
    ),
    "overlay_12v12": _with(
        _series(),
        _filled(),
        OVERLAY,
        f"SELECT series, pos, {_iso('date')} AS date, revenue FROM overlay",
    ),
    "last_rows": _with(
        _series("country"),
        f"SELECT {_iso('date')} AS date, year, month, country, CAST(revenue AS DOUBLE) AS revenue, "
        "row_number() OVER (PARTITION BY country ORDER BY date DESC) AS back FROM series "
        "QUALIFY back <= 6",
    ),
    "seasonal_naive": _with(
        _series("category"),
        _filled("category"),
        f"SELECT category, {_iso('date + INTERVAL 12 MONTH')} AS date, CAST(revenue AS DOUBLE) AS forecast "
        "FROM filled QUALIFY row_number() OVER (PARTITION BY category ORDER BY filled.date DESC) <= 12",
    ),
    "trend_by_category": _with(
        _series("category"),
        _filled("category"),
        """, fitted AS (
          SELECT category, max(date) AS last, max(t) AS last_t, regr_slope(y, t) AS slope,
                 regr_intercept(y, t) AS intercept
          FROM (SELECT *, CAST(year * 12 + month AS DOUBLE) AS t, CAST(revenue AS DOUBLE) AS y FROM filled)
          GROUP BY category) """,
        f"SELECT category, {_iso('last + INTERVAL 1 MONTH')} AS date, round(slope, 2) AS slope, "
        "round(intercept, 2) AS intercept, "
        "round(intercept + slope * (last_t + 1), 2) AS forecast FROM fitted",
    ),
    "kpi_card": _with(
        _series(),
        _filled(),
        _changes(),
        CARD,
        f"SELECT {_iso('date')} AS date, {_money('revenue')} AS revenue, {_percent('mom')} AS mom, "
        f"{_percent('yoy')} AS yoy, {_money('ytd')} AS ytd FROM card",
    ),
    "insights": _with(
        _series("category"),
        LATEST,
        ", total AS (SELECT date, sum(revenue) AS revenue FROM series GROUP BY date)",
        _filled(source="total"),
        _changes(),
        CARD,
        TOP3,
        f""", said AS (
          SELECT 1 AS k, printf('Revenue %s %.1f%% vs last month.',
                 CASE WHEN mom >= 0 THEN 'increased' ELSE 'decreased' END, abs(mom)) AS sentence
          FROM card WHERE mom IS NOT NULL
          UNION ALL
          SELECT 2, printf('Revenue %s %.1f%% vs last year.',
                 CASE WHEN yoy >= 0 THEN 'increased' ELSE 'decreased' END, abs(yoy))
          FROM card WHERE yoy IS NOT NULL
          UNION ALL
          SELECT 3, 'Top contributors this month: ' || string_agg(category || ' (' || {_money('revenue')} || ')',
                 ', ' ORDER BY revenue DESC, category) || '.' FROM top3)
        SELECT row_number() OVER (ORDER BY k) AS position, sentence FROM said""",
    ),
    "dashboard_series": _with(
        _series("category", "country"),
        LATEST,
        ", total AS (SELECT date, sum(revenue) AS revenue FROM series GROUP BY date)",
        _filled(source="total"),
        _band(),
        OVERLAY,
        _pareto("category"),
        _ranked("category"),
        f"""SELECT panel, series, x, round(y, 2) AS y FROM (
          SELECT 'trend' AS panel, 'Upper Band' AS series, {_iso('date')} AS x, ma + std AS y FROM band
          UNION ALL
          SELECT 'trend', 'Confidence Band', {_iso('date')},
                 CASE WHEN ma - std < 0 THEN 0 ELSE ma - std END FROM band
          UNION ALL SELECT 'trend', 'Revenue', {_iso('date')}, revenue FROM band
          UNION ALL SELECT 'trend', 'Anomaly', {_iso('date')}, revenue FROM band WHERE anomaly
          UNION ALL SELECT 'trend', series || ' (Indexed)', CAST(pos AS VARCHAR), revenue FROM overlay
          UNION ALL SELECT 'latest', 'Revenue', category, revenue FROM pareto
          UNION ALL SELECT 'latest', 'Pareto %', category, cum_share * 100 FROM pareto
          UNION ALL SELECT 'share', category, {_iso('date')}, revenue FROM top_series
          UNION ALL SELECT 'places', 'Revenue', country, {_total('revenue')} FROM series GROUP BY country)""",
    ),
    "dedupe_latest": """
        SELECT l_orderkey, l_linenumber, strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate, l_partkey,
               l_suppkey, l_extendedprice
        FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY lineitem.l_shipdate DESC, l_extendedprice DESC, l_partkey DESC, l_suppkey DESC) = 1""",
    "dedupe_exact": "SELECT DISTINCT l_partkey, l_suppkey, l_returnflag FROM lineitem",
    "dedupe_exact_rows": (
        "SELECT DISTINCT l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, "
        + ", ".join(
            f"CAST(CAST({c} AS DECIMAL(18,4)) AS DOUBLE) AS {c}"
            for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
        )
        + f", l_returnflag, l_linestatus, {_iso('l_shipdate')} AS l_shipdate FROM lineitem"
    ),
    "customer_ltv": _with(
        f"SELECT customer_id, {_total()} AS revenue, count(DISTINCT order_id) AS orders, "
        f"{_iso('min(order_date)')} AS first_order, {_iso('max(order_date)')} AS last_order, "
        "date_diff('day', min(order_date), max(order_date)) AS tenure_days, "
        f"{_total()} / count(DISTINCT order_id) AS avg_order_value "
        "FROM good GROUP BY customer_id"
    ),
    "customer_churn": _with(
        ", last AS (SELECT customer_id, max(order_date) AS d FROM good GROUP BY customer_id)",
        f"SELECT customer_id, {_iso('d')} AS last_order, "
        "date_diff('day', d, (SELECT max(d) FROM last)) AS recency_days, "
        "date_diff('day', d, (SELECT max(d) FROM last)) > 180 AS churned FROM last",
    ),
    "customer_retention": _with(
        ", active AS (SELECT DISTINCT customer_id, month_start AS date FROM good)",
        f"SELECT {_iso('a.date')} AS date, count(*) AS active, count(b.date) AS retained, "
        "round(count(b.date) / count(*), 6) AS retention FROM active a LEFT JOIN active b "
        "ON a.customer_id = b.customer_id AND b.date = a.date + INTERVAL 1 MONTH GROUP BY a.date",
    ),
    "daily_revenue_stream": """
        SELECT strftime(ts, '%Y-%m-%d') AS day, event_type,
               CAST(sum(CAST(value AS DECIMAL(18,4))) AS DOUBLE) AS revenue, count(*) AS events
        FROM events WHERE date_trunc('day', ts) + INTERVAL 1 DAY
             <= (SELECT max(ts) FROM events) - INTERVAL 1 DAY
        GROUP BY 1, 2""",
    "daily_revenue_live": ALL_DAYS,
    "daily_revenue_batch": ALL_DAYS,
    "distinct_event_stream": "SELECT DISTINCT event_id, user_id, event_type FROM events",
}
