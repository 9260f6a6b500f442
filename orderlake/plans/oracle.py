"""For each named query the same result in plain SQL, written independently of the operators."""

from __future__ import annotations

_LINE_ID = (
    "concat('L', CAST(l.l_orderkey AS VARCHAR), '-', CAST(l.l_linenumber AS VARCHAR), '-', "
    "CAST(l.l_partkey AS VARCHAR), '-', CAST(l.l_suppkey AS VARCHAR), '-', "
    "CAST(CAST(l.l_shipdate AS DATE) AS VARCHAR))"
)

# the three source tables and the steps after them, as common table expressions
_STEPS = {
    "order_items": f"""
        SELECT CASE WHEN l.l_orderkey % 3 = 0 THEN 'web' ELSE 'mobile' END AS APP_NAME,
          concat('R', CAST(l.l_suppkey AS VARCHAR)) AS RESTAURANT_ID,
          CAST(o.o_orderdate AS TIMESTAMP) AS CREATION_TIME_UTC,
          concat('O', CAST(l.l_orderkey AS VARCHAR)) AS ORDER_ID,
          CASE WHEN o.o_orderkey % 11 = 0 THEN NULL ELSE concat('U', CAST(o.o_custkey AS VARCHAR)) END AS USER_ID,
          CASE WHEN o.o_orderkey % 11 <> 0 AND c.c_mktsegment = 'BUILDING'
            THEN concat('00', CAST(o.o_custkey AS VARCHAR)) END AS PRINTED_CARD_NUMBER,
          CASE WHEN o.o_orderkey % 11 <> 0 AND c.c_mktsegment = 'BUILDING' THEN 'true' ELSE 'false' END AS IS_LOYALTY,
          'USD' AS CURRENCY,
          CASE WHEN l.l_orderkey % 1009 = 0 AND l.l_linenumber = 1 THEN NULL ELSE {_LINE_ID} END AS LINEITEM_ID,
          p.p_type AS ITEM_CATEGORY, p.p_name AS ITEM_NAME,
          CAST(p.p_retailprice AS DECIMAL(10,2)) AS ITEM_PRICE, CAST(l.l_quantity AS INT) AS ITEM_QUANTITY
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
          JOIN customer c ON o.o_custkey = c.c_custkey JOIN part p ON l.l_partkey = p.p_partkey""",
    "order_item_options": f"""
        SELECT concat(CASE WHEN l.l_orderkey % 997 = 0 THEN 'X' ELSE 'O' END, CAST(l.l_orderkey AS VARCHAR)) AS ORDER_ID,
          {_LINE_ID} AS LINEITEM_ID,
          CASE WHEN v.k = 1 THEN 'size' WHEN v.k = 2 THEN 'extra' ELSE 'side' END AS OPTION_GROUP_NAME,
          concat('opt', CAST(v.k AS VARCHAR)) AS OPTION_NAME,
          CASE WHEN v.k = 1 THEN CAST(CAST(l.l_partkey % 500 AS DECIMAL(10,2)) * CAST('0.01' AS DECIMAL(3,2)) AS DECIMAL(10,2))
            ELSE CAST(0 AS DECIMAL(10,2)) END AS OPTION_PRICE,
          CAST(1 AS INT) AS OPTION_QUANTITY
        FROM lineitem l CROSS JOIN (VALUES (1), (2), (3)) AS v(k) WHERE v.k <= (l.l_orderkey + l.l_linenumber) % 4""",
    "date_dim": """
        SELECT CASE WHEN year(d) >= 2000 AND day(d) % 2 = 0
            THEN concat(CAST(month(d) AS VARCHAR), '/', CAST(day(d) AS VARCHAR), '/', right(CAST(year(d) AS VARCHAR), 2))
            ELSE concat(lpad(CAST(day(d) AS VARCHAR), 2, '0'), '-', lpad(CAST(month(d) AS VARCHAR), 2, '0'), '-',
              CAST(year(d) AS VARCHAR)) END AS date_key,
          CAST(year(d) AS INT) AS year, CAST(month(d) AS INT) AS month, CAST(weekofyear(d) AS INT) AS week,
          left(dayname(d), 3) AS day_of_week,
          CASE WHEN (month(d) = 1 AND day(d) = 1) OR (month(d) = 7 AND day(d) = 4) OR (month(d) = 12 AND day(d) = 25)
            THEN 'true' ELSE 'false' END AS is_holiday,
          CASE WHEN left(dayname(d), 3) IN ('Sat', 'Sun') THEN 'true' ELSE 'false' END AS is_weekend,
          CASE WHEN month(d) = 1 AND day(d) = 1 THEN 'New Year' WHEN month(d) = 7 AND day(d) = 4 THEN 'July 4'
            WHEN month(d) = 12 AND day(d) = 25 THEN 'Christmas' END AS holiday_name
        FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders) x""",
    "calendar": """
        SELECT *, CAST(coalesce(try_strptime(date_key, '%d-%m-%Y'), try_strptime(date_key, '%m/%d/%y')) AS DATE) AS "DATE"
        FROM date_dim""",
    "valid_lines": "SELECT * FROM order_items WHERE LINEITEM_ID IS NOT NULL",
    "good_options": """
        SELECT * FROM order_item_options o WHERE EXISTS (SELECT 1 FROM valid_lines i
          WHERE i.ORDER_ID = o.ORDER_ID AND i.LINEITEM_ID = o.LINEITEM_ID)""",
    "line_options": """
        SELECT ORDER_ID, LINEITEM_ID, sum(OPTION_PRICE * OPTION_QUANTITY) AS TOTAL_OPTIONS_PRICE, count(*) AS NUM_OPTIONS
        FROM good_options GROUP BY ORDER_ID, LINEITEM_ID""",
    "silver": """
        SELECT i.*, r.TOTAL_OPTIONS_PRICE, r.NUM_OPTIONS,
          CAST(i.ITEM_PRICE * i.ITEM_QUANTITY + coalesce(r.TOTAL_OPTIONS_PRICE, 0) AS DECIMAL(18,2)) AS LINE_REVENUE,
          CAST(i.CREATION_TIME_UTC AS DATE) AS ORDER_DATE
        FROM valid_lines i LEFT JOIN line_options r ON i.ORDER_ID = r.ORDER_ID AND i.LINEITEM_ID = r.LINEITEM_ID""",
    "daily": """
        SELECT USER_ID, ORDER_DATE AS SNAPSHOT_DATE, sum(LINE_REVENUE) AS DAILY_SPEND,
          sum(sum(LINE_REVENUE)) OVER (PARTITION BY USER_ID ORDER BY ORDER_DATE
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS RUNNING_LTV
        FROM silver WHERE USER_ID IS NOT NULL GROUP BY USER_ID, ORDER_DATE""",
    "latest": "SELECT USER_ID, max(RUNNING_LTV) AS LATEST_LTV FROM daily GROUP BY USER_ID",
    "quintiles": """
        SELECT USER_ID, LATEST_LTV, ntile(5) OVER (ORDER BY LATEST_LTV NULLS FIRST, USER_ID) AS QUINTILE FROM latest""",
    "scores": """
        SELECT USER_ID, count(DISTINCT ORDER_ID) AS FREQUENCY, sum(LINE_REVENUE) AS MONETARY,
          date_diff('day', max(ORDER_DATE), DATE '2001-08-02') AS RECENCY
        FROM silver WHERE USER_ID IS NOT NULL GROUP BY USER_ID""",
    "dated": 'SELECT s.*, d.* EXCLUDE ("DATE") FROM silver s JOIN calendar d ON s.ORDER_DATE = d."DATE"',
}


def _with(body: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({text})" for n, text in _STEPS.items()) + "\n" + body


def _money(expression: str, name: str | None = None) -> str:
    return f"CAST({expression} AS DECIMAL(18,2)) AS {name or expression}"


# The average is rounded to six places and then to two, as division of wide decimals does; whole
# numbers keep it exact.
_AOV = (
    "CAST(CAST(((2 * CAST(sum(LINE_REVENUE) * 100 AS HUGEINT) * 10000 + count(DISTINCT ORDER_ID)) "
    "// (2 * count(DISTINCT ORDER_ID)) + 5000) // 10000 AS DECIMAL(18,0)) * CAST('0.01' AS DECIMAL(3,2)) "
    "AS DECIMAL(18,2)) AS AOV"
)
_REVENUE = _money("sum(LINE_REVENUE)", "TOTAL_REVENUE")
_ORDERS = "count(DISTINCT ORDER_ID) AS NUM_ORDERS"
_WATERMARK = "TIMESTAMP '2001-01-01 00:00:00'"
_STAMP = "strftime(CREATION_TIME_UTC, '%Y-%m-%dT%H:%M:%S.%f') AS CREATION_TIME_UTC"
_RUNS = ("2000-03-31", "2000-06-30", "2000-09-30", "2000-12-31")
_TIER = "CASE WHEN QUINTILE = 5 THEN 'High' WHEN QUINTILE = 1 THEN 'Low' ELSE 'Med' END"

# The columns of the three source tables.
_COLUMNS = {
    "order_items": "APP_NAME RESTAURANT_ID CREATION_TIME_UTC ORDER_ID USER_ID PRINTED_CARD_NUMBER IS_LOYALTY "
    "CURRENCY LINEITEM_ID ITEM_CATEGORY ITEM_NAME ITEM_PRICE ITEM_QUANTITY",
    "order_item_options": "ORDER_ID LINEITEM_ID OPTION_GROUP_NAME OPTION_NAME OPTION_PRICE OPTION_QUANTITY",
    "date_dim": "date_key year month week day_of_week is_holiday is_weekend holiday_name",
}


def _revenue_by(table: str, columns: str, measures: str = f"{_REVENUE}, {_ORDERS}, {_AOV}") -> str:
    return f"SELECT {columns}, {measures} FROM {table} GROUP BY {columns}"


def _per_table(select: str) -> str:
    return " UNION ALL ".join(select.format(table=t) for t in _COLUMNS)


def _per_column(select: str) -> str:
    pairs = [(t, c) for t, columns in _COLUMNS.items() for c in columns.split()]
    return " UNION ALL ".join(select.format(table=t, column=c) for t, c in pairs)


def _as_of(day: str) -> str:
    return (
        f"SELECT USER_ID, DATE '{day}' AS AS_OF, {_money('arg_max(RUNNING_LTV, SNAPSHOT_DATE)', 'VALUE')} "
        f"FROM daily WHERE SNAPSHOT_DATE <= DATE '{day}' GROUP BY USER_ID"
    )


def _tiers(day: str) -> str:
    return (
        f"(SELECT USER_ID, {_TIER} AS tag FROM (SELECT USER_ID, ntile(5) OVER (ORDER BY max(RUNNING_LTV), USER_ID) "
        f"AS QUINTILE FROM daily WHERE SNAPSHOT_DATE <= DATE '{day}' GROUP BY USER_ID) q)"
    )


_QUERIES = {
    "scan_partition": """SELECT ORDER_ID, LINEITEM_ID, ITEM_PRICE FROM order_items
        WHERE CAST(CREATION_TIME_UTC AS DATE) = DATE '2000-04-04'""",
    "incremental_items": f"SELECT ORDER_ID, LINEITEM_ID FROM order_items WHERE CREATION_TIME_UTC > {_WATERMARK}",
    "incremental_options": f"""SELECT ORDER_ID, LINEITEM_ID, OPTION_NAME FROM order_item_options o
        WHERE EXISTS (SELECT 1 FROM order_items i WHERE i.ORDER_ID = o.ORDER_ID AND i.LINEITEM_ID = o.LINEITEM_ID
          AND i.CREATION_TIME_UTC > {_WATERMARK})""",
    "full_reload_dim": "SELECT date_key FROM date_dim",
    "batch_watermark": f"""SELECT strftime(max(CREATION_TIME_UTC), '%Y-%m-%dT%H:%M:%S.%f') AS WATERMARK
        FROM order_items WHERE CREATION_TIME_UTC > {_WATERMARK}""",
    "valid_items": "SELECT ORDER_ID, LINEITEM_ID FROM valid_lines",
    "corrupt_items": """SELECT ORDER_ID, LINEITEM_ID, 'LINEITEM_ID is NULL' AS REJECT_REASON
        FROM order_items WHERE LINEITEM_ID IS NULL""",
    "valid_options": "SELECT ORDER_ID, LINEITEM_ID, OPTION_NAME FROM good_options",
    "orphan_options": """SELECT ORDER_ID, LINEITEM_ID, OPTION_NAME, 'ORPHAN_OPTION_NO_MATCHING_ORDER' AS REJECT_REASON
        FROM order_item_options o WHERE NOT EXISTS (SELECT 1 FROM valid_lines i
          WHERE i.ORDER_ID = o.ORDER_ID AND i.LINEITEM_ID = o.LINEITEM_ID)""",
    "quarantine_conservation": """
        SELECT 'order_items' AS TABLE_NAME, count(*) AS n_in, count(LINEITEM_ID) AS n_valid,
          count(*) - count(LINEITEM_ID) AS n_rejected FROM order_items
        UNION ALL SELECT 'order_item_options', (SELECT count(*) FROM order_item_options),
          (SELECT count(*) FROM good_options),
          (SELECT count(*) FROM order_item_options) - (SELECT count(*) FROM good_options)""",
    "lines_without_options": """SELECT ORDER_ID, LINEITEM_ID FROM valid_lines i
        WHERE NOT EXISTS (SELECT 1 FROM order_item_options o
          WHERE i.ORDER_ID = o.ORDER_ID AND i.LINEITEM_ID = o.LINEITEM_ID)""",
    "corrupt_options": """SELECT ORDER_ID, LINEITEM_ID, OPTION_NAME, CASE WHEN OPTION_PRICE IS NOT NULL
          THEN 'OPTION_QUANTITY is NULL' WHEN OPTION_QUANTITY IS NOT NULL THEN 'OPTION_PRICE is NULL'
          ELSE 'OPTION_PRICE is NULL, OPTION_QUANTITY is NULL' END AS REJECT_REASON
        FROM (SELECT * REPLACE (
            CASE WHEN k % 23 = 0 THEN NULL WHEN k % 29 = 0 THEN -OPTION_PRICE ELSE OPTION_PRICE END AS OPTION_PRICE,
            CASE WHEN k % 31 = 0 THEN NULL ELSE OPTION_QUANTITY END AS OPTION_QUANTITY)
          FROM (SELECT *, CAST(substr(ORDER_ID, 2) AS BIGINT) AS k FROM order_item_options) x) y
        WHERE OPTION_PRICE IS NULL OR OPTION_QUANTITY IS NULL""",
    "unparsed_values": """SELECT ORDER_ID, LINEITEM_ID, concat_ws(', ',
            CASE WHEN k % 13 = 0 THEN 'ITEM_PRICE is not decimal(10,2)' END,
            CASE WHEN k % 17 = 0 THEN 'ITEM_QUANTITY is not int' END,
            CASE WHEN k % 19 = 0 THEN 'CREATION_TIME_UTC is not timestamp' END) AS REJECT_REASON
        FROM (SELECT *, CAST(substr(ORDER_ID, 2) AS BIGINT) AS k FROM order_items) x
        WHERE k % 13 = 0 OR k % 17 = 0 OR k % 19 = 0""",
    "nonempty_keys": "SELECT ORDER_ID, LINEITEM_ID FROM order_items WHERE LINEITEM_ID <> ''",
    "typed_projection": """
        SELECT ORDER_ID, LINEITEM_ID, TRY_CAST(price AS DECIMAL(10,2)) AS ITEM_PRICE,
          TRY_CAST(quantity AS INT) AS ITEM_QUANTITY,
          strftime(TRY_CAST(created AS TIMESTAMP), '%Y-%m-%dT%H:%M:%S.%f') AS CREATION_TIME_UTC
        FROM (SELECT ORDER_ID, LINEITEM_ID,
            CASE WHEN k % 13 = 0 THEN concat('$', CAST(ITEM_PRICE AS VARCHAR)) ELSE CAST(ITEM_PRICE AS VARCHAR) END AS price,
            CASE WHEN k % 17 = 0 THEN '' ELSE CAST(ITEM_QUANTITY AS VARCHAR) END AS quantity,
            CASE WHEN k % 19 = 0 THEN 'unknown' ELSE strftime(CREATION_TIME_UTC, '%Y-%m-%d %H:%M:%S') END AS created
          FROM (SELECT *, CAST(substr(ORDER_ID, 2) AS BIGINT) AS k FROM order_items) x) t""",
    "point_lookup": f"""SELECT ORDER_ID, LINEITEM_ID, {_money('TOTAL_OPTIONS_PRICE')}, LINE_REVENUE
        FROM silver WHERE ORDER_ID = 'O1'""",
    "day_lookup": """SELECT ORDER_ID, LINEITEM_ID, ORDER_DATE, LINE_REVENUE FROM silver
        WHERE ORDER_DATE = DATE '2000-04-04'""",
    "row_counts": _per_table("SELECT '{table}' AS TABLE_NAME, count(*) AS NUM_ROWS FROM {table}"),
    "null_profile": _per_column(
        "SELECT '{table}' AS TABLE_NAME, '{column}' AS COLUMN_NAME, count(*) - count({column}) AS NUM_NULLS FROM {table}"
    ),
    "column_profile": _per_column(
        "SELECT '{table}' AS TABLE_NAME, '{column}' AS COLUMN_NAME, count(DISTINCT {column}) AS NUM_DISTINCT, "
        "count(*) - count({column}) AS NUM_NULLS, count(DISTINCT {column}) = 1 AS IS_CONSTANT FROM {table}"
    ),
    "duplicate_rows": _per_table(
        "SELECT '{table}' AS TABLE_NAME, (SELECT count(*) FROM {table}) - "
        "(SELECT count(*) FROM (SELECT DISTINCT * FROM {table}) u) AS NUM_DUPLICATES"
    ),
    "repeated_keys": """SELECT ORDER_ID, LINEITEM_ID, count(*) AS NUM_ROWS FROM order_item_options
        GROUP BY ORDER_ID, LINEITEM_ID HAVING count(*) > 1""",
    "loyalty_card_consistency": """SELECT IS_LOYALTY, PRINTED_CARD_NUMBER IS NULL AS CARD_IS_NULL,
          count(*) AS NUM_LINES FROM order_items GROUP BY 1, 2""",
    "options_per_line": """SELECT n AS NUM_OPTIONS, count(*) AS NUM_LINES FROM (
          SELECT coalesce(NUM_OPTIONS, 0) AS n FROM silver) x GROUP BY n""",
    "options_rollup": f"""SELECT ORDER_ID, LINEITEM_ID, {_money('TOTAL_OPTIONS_PRICE')}, NUM_OPTIONS
        FROM line_options""",
    "line_revenue": "SELECT ORDER_ID, LINEITEM_ID, LINE_REVENUE FROM silver",
    "order_date_parts": """SELECT LINEITEM_ID, d AS ORDER_DATE, CAST(year(d) AS INT) AS year,
          CAST(month(d) AS INT) AS month, CAST(day(d) AS INT) AS day
        FROM (SELECT LINEITEM_ID, CAST(CREATION_TIME_UTC AS DATE) AS d FROM order_items) x""",
    "parse_date_dim": 'SELECT date_key, "DATE" FROM calendar',
    "order_items_enriched": f"""SELECT * EXCLUDE (CREATION_TIME_UTC, TOTAL_OPTIONS_PRICE), {_STAMP},
          {_money('TOTAL_OPTIONS_PRICE')}, CAST(year(ORDER_DATE) AS INT) AS year,
          CAST(month(ORDER_DATE) AS INT) AS month, CAST(day(ORDER_DATE) AS INT) AS day FROM silver""",
    "daily_spend_ltv": f"SELECT USER_ID, SNAPSHOT_DATE, {_money('DAILY_SPEND')}, {_money('RUNNING_LTV')} FROM daily",
    "customer_quintile": f"SELECT USER_ID, {_money('LATEST_LTV')}, CAST(QUINTILE AS INT) AS QUINTILE FROM quintiles",
    "clv": f"""SELECT d.USER_ID, SNAPSHOT_DATE, {_money('DAILY_SPEND')}, {_money('RUNNING_LTV')}, {_TIER} AS CLV_TAG
        FROM daily d LEFT JOIN quintiles q ON d.USER_ID = q.USER_ID""",
    "line_running_ltv": """SELECT USER_ID, LINEITEM_ID, ORDER_DATE, CAST(sum(LINE_REVENUE) OVER (
          PARTITION BY USER_ID ORDER BY ORDER_DATE RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
          AS DECIMAL(18,2)) AS RUNNING_LTV FROM silver""",
    "rfm": f"""SELECT USER_ID, FREQUENCY, {_money('MONETARY')}, CAST(RECENCY AS INT) AS RECENCY FROM scores""",
    "rfm_churn": f"""SELECT USER_ID, FREQUENCY, {_money('MONETARY')}, CAST(RECENCY AS INT) AS RECENCY,
          RECENCY > 90 AS IS_CHURNED FROM scores""",
    "rfm_scores": """SELECT USER_ID, CAST(ntile(5) OVER (ORDER BY RECENCY DESC, USER_ID) AS INT) AS R_SCORE,
          CAST(ntile(5) OVER (ORDER BY FREQUENCY, USER_ID) AS INT) AS F_SCORE,
          CAST(ntile(5) OVER (ORDER BY MONETARY NULLS FIRST, USER_ID) AS INT) AS M_SCORE FROM scores""",
    "clv_as_of": f"SELECT USER_ID, VALUE FROM ({_as_of('1998-06-30')}) x",
    "clv_as_of_days": " UNION ALL ".join(
        _as_of(day) for day in _RUNS
    ),
    "clv_as_of_points": f"""SELECT p.ORDER_ID, p.USER_ID, p.AS_OF, {_money('d.RUNNING_LTV', 'VALUE')}
        FROM (SELECT concat('O', CAST(o_orderkey AS VARCHAR)) AS ORDER_ID, concat('U', CAST(o_custkey AS VARCHAR)) AS USER_ID,
            CAST(o_orderdate AS DATE) + CAST(o_orderkey % 61 - 45 AS INT) AS AS_OF FROM orders) p
          ASOF LEFT JOIN daily d ON p.USER_ID = d.USER_ID AND p.AS_OF >= d.SNAPSHOT_DATE""",
    "clv_tag_history": f"""
        SELECT USER_ID, tag AS CLV_TAG, d AS VALID_FROM, upto AS VALID_TO
        FROM (SELECT *, lead(d) OVER (PARTITION BY USER_ID ORDER BY d) AS upto
          FROM (SELECT *, lag(tag) OVER (PARTITION BY USER_ID ORDER BY d) AS earlier
            FROM (SELECT c.USER_ID, r.d, t.tag
              FROM (SELECT DISTINCT USER_ID FROM daily) c
                CROSS JOIN (VALUES {', '.join(f"(DATE '{day}')" for day in _RUNS)}) r(d)
                LEFT JOIN ({' UNION ALL '.join(f"SELECT DATE '{day}' AS d, x.* FROM {_tiers(day)} x" for day in _RUNS)}) t
                  ON t.USER_ID = c.USER_ID AND t.d = r.d) runs) changes
          WHERE tag IS DISTINCT FROM earlier) tagged
        WHERE tag IS NOT NULL""",
    "clv_latest_refund_safe": f"""SELECT USER_ID, {_money('arg_max(RUNNING_LTV, SNAPSHOT_DATE)', 'LATEST_LTV')}
        FROM daily GROUP BY USER_ID""",
    "clv_tag_migration": f"""SELECT coalesce(a.tag, 'New') AS FROM_TAG, coalesce(b.tag, 'New') AS TO_TAG,
          count(*) AS CUSTOMERS
        FROM {_tiers('1998-06-30')} a FULL JOIN {_tiers('2000-06-30')} b ON a.USER_ID = b.USER_ID GROUP BY 1, 2""",
    "order_gaps": """
        SELECT USER_ID, CAST(date_diff('day', max(d), DATE '2001-08-02') AS INT) AS DAYS_SINCE_LAST,
          CASE WHEN count(gap) > 0 THEN CAST(CAST((2000 * sum(gap) + count(gap)) // (2 * count(gap)) AS DECIMAL(14,0))
            * CAST('0.001' AS DECIMAL(4,3)) AS DECIMAL(14,3)) END AS MEAN_GAP_DAYS
        FROM (SELECT USER_ID, d, date_diff('day', lag(d) OVER (PARTITION BY USER_ID ORDER BY d), d) AS gap
          FROM (SELECT DISTINCT USER_ID, ORDER_DATE AS d FROM silver WHERE USER_ID IS NOT NULL) x) y GROUP BY USER_ID""",
    "spend_trend": """
        SELECT USER_ID, CAST(a AS DECIMAL(18,2)) AS LAST_SPEND, CAST(b AS DECIMAL(18,2)) AS PREVIOUS_SPEND,
          CAST(a - b AS DECIMAL(18,2)) AS SPEND_CHANGE
        FROM (SELECT USER_ID,
            coalesce(sum(LINE_REVENUE) FILTER (WHERE ORDER_DATE > DATE '2001-08-02' - INTERVAL 90 DAY
              AND ORDER_DATE <= DATE '2001-08-02'), 0) AS a,
            coalesce(sum(LINE_REVENUE) FILTER (WHERE ORDER_DATE > DATE '2001-08-02' - INTERVAL 180 DAY
              AND ORDER_DATE <= DATE '2001-08-02' - INTERVAL 90 DAY), 0) AS b
          FROM silver WHERE USER_ID IS NOT NULL GROUP BY USER_ID) x""",
    "daily_sales": _revenue_by(
        "silver", "ORDER_DATE", f"{_REVENUE}, {_ORDERS}, count(*) AS NUM_LINE_ITEMS, {_AOV}"
    ),
    "location_perf": _revenue_by("silver", "RESTAURANT_ID"),
    "top_locations": _revenue_by("silver", "RESTAURANT_ID")
    + " ORDER BY sum(LINE_REVENUE) DESC, RESTAURANT_ID LIMIT 10",
    "location_rank": f"""SELECT RESTAURANT_ID, {_REVENUE},
          CAST(rank() OVER (ORDER BY sum(LINE_REVENUE) DESC) AS INT) AS REVENUE_RANK FROM silver GROUP BY RESTAURANT_ID""",
    "location_channel": f"""SELECT RESTAURANT_ID, APP_NAME, CAST(grouping_id(RESTAURANT_ID, APP_NAME) AS INT) AS GROUPING_LEVEL,
          {_REVENUE}, {_ORDERS} FROM silver GROUP BY ROLLUP (RESTAURANT_ID, APP_NAME)""",
    "order_revenue": _revenue_by("silver", "ORDER_ID", f"{_REVENUE}, count(*) AS NUM_LINE_ITEMS"),
    "sales_calendar": _revenue_by("dated", "ORDER_DATE, day_of_week, is_holiday", _REVENUE),
    "sales_by_weekday": _revenue_by("dated", "day_of_week"),
    "sales_by_month": _revenue_by("dated", "year, month"),
    "sales_by_week": _revenue_by("dated", "year, week"),
    "sales_by_holiday": _revenue_by("dated", "is_holiday, holiday_name"),
    "sales_by_category": _revenue_by("silver", "ITEM_CATEGORY"),
    "loyalty_impact": _revenue_by(
        "silver", "IS_LOYALTY", f"{_REVENUE}, {_ORDERS}, count(DISTINCT USER_ID) AS NUM_CUSTOMERS, {_AOV}"
    ),
    "revenue_cube": f"""SELECT IS_LOYALTY, RESTAURANT_ID, APP_NAME,
          CAST(grouping_id(IS_LOYALTY, RESTAURANT_ID, APP_NAME) AS INT) AS GROUPING_LEVEL, {_REVENUE}, {_ORDERS}
        FROM silver GROUP BY CUBE (IS_LOYALTY, RESTAURANT_ID, APP_NAME)""",
    "discounts": f"""SELECT count(*) AS NUM_DISCOUNTS,
          {_money('coalesce(sum(OPTION_PRICE * OPTION_QUANTITY), 0)', 'TOTAL_DISCOUNT')}
        FROM (SELECT * REPLACE (
            CASE WHEN k % 23 = 0 THEN NULL WHEN k % 29 = 0 THEN -OPTION_PRICE ELSE OPTION_PRICE END AS OPTION_PRICE,
            CASE WHEN k % 31 = 0 THEN NULL ELSE OPTION_QUANTITY END AS OPTION_QUANTITY)
          FROM (SELECT *, CAST(substr(ORDER_ID, 2) AS BIGINT) AS k FROM order_item_options) x) y WHERE OPTION_PRICE < 0""",
    "missing_calendar_days": """SELECT ORDER_DATE, count(*) AS NUM_LINE_ITEMS FROM silver
        WHERE NOT EXISTS (SELECT 1 FROM calendar d WHERE d."DATE" = ORDER_DATE AND d."DATE" < DATE '2001-07-01')
        GROUP BY ORDER_DATE""",
}


def oracle_sql() -> dict[str, str]:
    return {name: _with(body) for name, body in _QUERIES.items()}
