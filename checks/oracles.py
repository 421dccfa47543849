"""Independent SQL for every registered query, run by DuckDB over the same Parquet tables.

Each text is a SELECT over named steps; the steps it needs are put in front as CTEs. Money is
summed as decimal and cast to double last; ratios divide doubles.
"""

from __future__ import annotations

import re

LINE_ID = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)"
RAW_ITEM_COLUMNS = (
    "ORDER_ID",
    "APP_NAME",
    "RESTAURANT_ID",
    "CURRENCY",
    "ITEM_CATEGORY",
    "ITEM_NAME",
    "CREATION_TIME_UTC",
    "ITEM_PRICE",
    "ITEM_QUANTITY",
    "IS_LOYALTY",
    "USER_ID",
    "PRINTED_CARD_NUMBER",
)
RAW_DATE_COLUMNS = ("year", "month", "week", "day_of_week", "is_weekend", "is_holiday", "holiday_name")
RAW_OPTION_COLUMNS = (
    "ORDER_ID",
    "LINEITEM_ID",
    "OPTION_GROUP_NAME",
    "OPTION_NAME",
    "OPTION_PRICE",
    "OPTION_QUANTITY",
)


def _nulls_first(columns: tuple[str, ...]) -> str:
    return ", ".join(f"{c} NULLS FIRST" for c in columns)


def dbl(expression: str, name: str | None = None) -> str:
    return f"CAST({expression} AS DOUBLE) AS {name or expression}"


def ratio(top: str, bottom: str) -> str:
    return f"(CAST({top} AS DOUBLE) / nullif(CAST({bottom} AS DOUBLE), 0))"


TIME_OF_DAY = """CASE WHEN hour(CREATION_TIME_UTC) < 6 THEN 'Late Night'
    WHEN hour(CREATION_TIME_UTC) < 12 THEN 'Morning'
    WHEN hour(CREATION_TIME_UTC) < 17 THEN 'Afternoon'
    WHEN hour(CREATION_TIME_UTC) < 21 THEN 'Evening' ELSE 'Night' END"""

SALES_MEASURES = """CAST(sum(ITEM_PRICE * ITEM_QUANTITY) AS DECIMAL(38,2)) AS TOTAL_REVENUE,
    count(DISTINCT ORDER_ID) AS TOTAL_ORDERS, CAST(sum(ITEM_QUANTITY) AS BIGINT) AS ITEMS_SOLD"""


def _sales(period: str, date: str = "NULL", year: str = "NULL", week: str = "NULL",
           month: str = "NULL") -> str:
    return f"""SELECT CAST({date} AS DATE) AS SALES_DATE, RESTAURANT_ID, ITEM_CATEGORY,
    {TIME_OF_DAY} AS TIME_OF_DAY, {SALES_MEASURES}, '{period}' AS SALES_PERIOD,
    CAST({year} AS INTEGER) AS YEAR, CAST({week} AS INTEGER) AS WEEK,
    CAST({month} AS INTEGER) AS MONTH
    FROM items GROUP BY ALL"""


TIME = "CREATION_TIME_UTC"
DAILY = _sales("DAILY", date=TIME)
WEEKLY = _sales("WEEKLY", year=f"year({TIME})", week=f"week({TIME})")
WEEKLY_ISO = _sales("WEEKLY", year=f"isoyear({TIME})", week=f"week({TIME})")
MONTHLY = _sales("MONTHLY", year=f"year({TIME})", month=f"month({TIME})")


def _locations(day: str) -> str:
    return f"""SELECT RESTAURANT_ID,
    CAST(sum(ITEM_PRICE * ITEM_QUANTITY) AS DECIMAL(38,2)) AS TOTAL_REVENUE,
    count(DISTINCT ORDER_ID) AS TOTAL_ORDERS, count(DISTINCT {day}) AS ACTIVE_DAYS,
    min({TIME}) AS FIRST_ORDER_DATE, max({TIME}) AS LAST_ORDER_DATE
    FROM items GROUP BY RESTAURANT_ID"""


LOCATION_RATES = f"""{ratio('TOTAL_ORDERS', 'ACTIVE_DAYS')} AS ORDERS_PER_DAY,
    {ratio('ACTIVE_DAYS', '7')} AS ACTIVE_WEEKS,
    {ratio('TOTAL_ORDERS', ratio('ACTIVE_DAYS', '7'))} AS ORDERS_PER_WEEK,
    {ratio('TOTAL_REVENUE', 'TOTAL_ORDERS')} AS AVG_ORDER_VALUE"""


def _score(metric: str, high_is_good: bool) -> str:
    sign, limits = (">=", (0.8, 0.6, 0.4, 0.2)) if high_is_good else ("<=", (0.2, 0.4, 0.6, 0.8))
    whens = " ".join(f"WHEN {metric} {sign} {q} THEN {5 - i}" for i, q in enumerate(limits))
    return f"CASE {whens} ELSE 1 END"


STEPS = {
    "raw_items": f"""SELECT CASE WHEN (l_orderkey + l_partkey) % 499 <> 0 THEN {LINE_ID} END
      AS LINEITEM_ID, CAST(l_orderkey AS VARCHAR) AS ORDER_ID,
    o_orderpriority AS APP_NAME, ' R' || l_suppkey || ' ' AS RESTAURANT_ID, ' USD' AS CURRENCY,
    p_type || ' ' AS ITEM_CATEGORY, p_name AS ITEM_NAME,
    CASE WHEN (l_orderkey + l_partkey) % 307 = 0 THEN 'soon' ELSE
      strftime(o_orderdate + to_minutes(CAST(o_orderkey * 7919 % 1440 AS INTEGER)),
        '%Y-%m-%d %H:%M:%S') END AS CREATION_TIME_UTC,
    CASE WHEN (l_orderkey + l_partkey) % 83 = 0 THEN 'n/a'
      WHEN (l_orderkey + l_partkey) % 79 = 0 THEN '123456789012.50'
      ELSE CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS VARCHAR) END AS ITEM_PRICE,
    CASE WHEN copy = 1 AND o_orderkey % 3 = 0 THEN '1'
      WHEN (l_orderkey + l_partkey) % 97 = 0 THEN '0'
      WHEN (l_orderkey + l_partkey) % 89 = 0 THEN NULL
      WHEN (l_orderkey + l_partkey) % 73 = 0 THEN 'some'
      WHEN (l_orderkey + l_partkey) % 71 = 0 THEN '99999999999'
      WHEN (l_orderkey + l_partkey) % 7 = 0 THEN CAST(l_quantity AS INTEGER) || '.0'
      ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS ITEM_QUANTITY,
    CASE WHEN o_orderkey % 10 = 0 THEN CAST(1 - o_custkey % 2 AS VARCHAR)
      WHEN o_custkey % 3 = 0 THEN NULL WHEN o_custkey % 19 = 0 THEN 'yes'
      WHEN o_custkey % 13 = 0 THEN '1.0'
      ELSE CAST(o_custkey % 2 AS VARCHAR) END AS IS_LOYALTY,
    CASE WHEN o_custkey % 7 = 0 THEN NULL WHEN o_custkey % 11 = 0 THEN ''
      ELSE 'U' || o_custkey END AS USER_ID,
    CASE WHEN o_custkey % 14 = 0 THEN NULL WHEN o_custkey % 5 = 0 THEN '  '
      ELSE ' C' || o_custkey END AS PRINTED_CARD_NUMBER
    FROM (SELECT *, 0 AS copy FROM lineitem
      UNION ALL SELECT *, 1 AS copy FROM lineitem WHERE l_orderkey % 17 = 0)
    JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
    "raw_options": f"""SELECT CAST(l_orderkey AS VARCHAR) AS ORDER_ID, {LINE_ID} AS LINEITEM_ID,
      l_returnflag || ' ' AS OPTION_GROUP_NAME, l_linestatus AS OPTION_NAME,
      CAST(CAST(CAST(l_tax AS DECIMAL(10,2)) * 100 AS DECIMAL(10,2)) AS VARCHAR) AS OPTION_PRICE,
      CAST(1 + l_linenumber % 3 AS INTEGER) || '.0' AS OPTION_QUANTITY
    FROM lineitem WHERE l_tax > 0
    UNION ALL SELECT CAST(l_orderkey AS VARCHAR), {LINE_ID}, 'DISCOUNT', ' promo',
      CAST(CAST(CAST(l_discount AS DECIMAL(10,2)) * -100 AS DECIMAL(10,2)) AS VARCHAR), '1.0'
    FROM lineitem WHERE l_discount >= 0.09 AND l_orderkey % 3 = 0
    UNION ALL SELECT CAST(l_orderkey AS VARCHAR), {LINE_ID}, 'DISCOUNT', 'promo',
      CAST(CAST(CAST(l_discount AS DECIMAL(10,2)) * -100 AS DECIMAL(10,2)) AS VARCHAR), '1.0'
    FROM lineitem WHERE l_discount >= 0.09 AND l_orderkey % 39 = 0""",
    "raw_dates": """SELECT spelling AS date_key, CAST(year(d) AS VARCHAR) AS year,
    CAST(month(d) AS VARCHAR) AS month, CAST(weekofyear(d) AS VARCHAR) AS week,
    ' ' || dayname(d) AS day_of_week,
    CASE WHEN isodow(d) >= 6 THEN 'true' ELSE 'false' END AS is_weekend,
    CASE WHEN strftime(d, '%m-%d') IN ('12-25', '01-01') THEN 'true' ELSE 'false' END
      AS is_holiday,
    CASE strftime(d, '%m-%d') WHEN '12-25' THEN 'Christmas ' WHEN '01-01' THEN 'New Year' END
      AS holiday_name
    FROM (SELECT d, unnest(CASE WHEN day(d) % 7 = 0
        THEN [strftime(d, '%Y-%m-%d'), strftime(d, '%Y-%m-%d'), strftime(d, '%Y-%-m-%-d')]
        ELSE [strftime(d, '%Y-%m-%d')] END) AS spelling
      FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders))""",
    "raw_items_once": f"""SELECT * EXCLUDE (copy) FROM (SELECT *, row_number() OVER (
      PARTITION BY LINEITEM_ID ORDER BY {_nulls_first(RAW_ITEM_COLUMNS)}) AS copy FROM raw_items)
    WHERE copy = 1""",
    "items": """SELECT LINEITEM_ID, ORDER_ID, trim(APP_NAME) AS APP_NAME,
    trim(RESTAURANT_ID) AS RESTAURANT_ID, trim(CURRENCY) AS CURRENCY,
    trim(ITEM_CATEGORY) AS ITEM_CATEGORY, trim(ITEM_NAME) AS ITEM_NAME,
    TRY_CAST(CREATION_TIME_UTC AS TIMESTAMP) AS CREATION_TIME_UTC,
    TRY_CAST(ITEM_PRICE AS DECIMAL(10,2)) AS ITEM_PRICE, ITEM_COUNT AS ITEM_QUANTITY,
    coalesce(TRY_CAST(IS_LOYALTY AS DOUBLE) = 1, false) AS IS_LOYALTY, USER_ID,
    trim(PRINTED_CARD_NUMBER) AS PRINTED_CARD_NUMBER,
    CASE WHEN USER_ID IS NULL OR trim(USER_ID) = '' THEN 'MISSING_USER_ID'
      ELSE 'VALID_USER_ID' END AS USER_ID_STATUS,
    CASE WHEN PRINTED_CARD_NUMBER IS NULL OR trim(PRINTED_CARD_NUMBER) = ''
      THEN 'MISSING_CARD_NUMBER' ELSE 'VALID_CARD_NUMBER' END AS CARD_NUMBER_STATUS
    FROM (SELECT *, TRY_CAST(regexp_replace(ITEM_QUANTITY, '\\.\\d*\\s*$', '') AS INTEGER) AS ITEM_COUNT
      FROM raw_items_once) WHERE ITEM_COUNT > 0""",
    "options": """SELECT ORDER_ID, LINEITEM_ID, trim(OPTION_GROUP_NAME) AS OPTION_GROUP_NAME,
    trim(OPTION_NAME) AS OPTION_NAME, CAST(OPTION_PRICE AS DECIMAL(10,2)) AS OPTION_PRICE,
    CAST(CAST(OPTION_QUANTITY AS DOUBLE) AS INTEGER) AS OPTION_QUANTITY FROM raw_options GROUP BY 1, 2, 3, 4, 5, 6 HAVING count(*) = 1""",
    "dates": f"""SELECT CAST(date_key AS DATE) AS date_key, CAST(year AS INTEGER) AS year,
    CAST(month AS INTEGER) AS month, CAST(week AS INTEGER) AS week,
    trim(day_of_week) AS day_of_week, CAST(is_weekend AS BOOLEAN) AS is_weekend,
    CAST(is_holiday AS BOOLEAN) AS is_holiday, trim(holiday_name) AS holiday_name
    FROM (SELECT *, row_number() OVER (PARTITION BY date_key ORDER BY
      {_nulls_first(RAW_DATE_COLUMNS)}) AS copy FROM raw_dates) WHERE copy = 1""",
    "buyers": """SELECT *, coalesce(USER_ID, PRINTED_CARD_NUMBER) AS CUSTOMER_ID,
    ITEM_PRICE * ITEM_QUANTITY AS REVENUE FROM items
    WHERE coalesce(USER_ID, PRINTED_CARD_NUMBER) IS NOT NULL""",
    "buyers_fixed": """SELECT * FROM (SELECT *,
      coalesce(CASE WHEN trim(USER_ID) <> '' THEN USER_ID END,
        CASE WHEN trim(PRINTED_CARD_NUMBER) <> '' THEN PRINTED_CARD_NUMBER END) AS CUSTOMER_ID
      FROM items) WHERE CUSTOMER_ID IS NOT NULL""",
    "now": "SELECT max(CREATION_TIME_UTC) AS today FROM buyers",
    "line_options": """SELECT ORDER_ID, LINEITEM_ID,
    sum(OPTION_PRICE * OPTION_QUANTITY) AS OPTION_REVENUE FROM options GROUP BY 1, 2""",
    "line_totals": """SELECT b.*, b.ITEM_PRICE * b.ITEM_QUANTITY AS ITEM_REVENUE,
    coalesce(o.OPTION_REVENUE, 0) AS OPTION_REVENUE,
    b.ITEM_PRICE * b.ITEM_QUANTITY + coalesce(o.OPTION_REVENUE, 0) AS TOTAL_LINE_REVENUE
    FROM items b LEFT JOIN line_options o USING (ORDER_ID, LINEITEM_ID)""",
    "clv": """SELECT coalesce(USER_ID, PRINTED_CARD_NUMBER) AS CUSTOMER_ID,
    sum(TOTAL_LINE_REVENUE) AS CUSTOMER_LIFETIME_VALUE FROM line_totals
    WHERE coalesce(USER_ID, PRINTED_CARD_NUMBER) IS NOT NULL GROUP BY 1""",
    "clv_ranked": """SELECT *, percent_rank() OVER (
      ORDER BY CUSTOMER_LIFETIME_VALUE NULLS FIRST) AS PERCENT_RANK FROM clv""",
    "clv_gold": """SELECT *, CASE WHEN PERCENT_RANK >= 0.80 THEN 'High CLV'
    WHEN PERCENT_RANK >= 0.20 THEN 'Medium CLV' ELSE 'Low CLV' END AS CLV_SEGMENT
    FROM clv_ranked""",
    "rfm_base": """SELECT CUSTOMER_ID, max(CREATION_TIME_UTC) AS LAST_PURCHASE_DATE,
    count(DISTINCT ORDER_ID) AS FREQUENCY, sum(REVENUE) AS MONETARY,
    bool_or(IS_LOYALTY) AS IS_LOYALTY FROM buyers GROUP BY 1""",
    "rfm_recency": """SELECT rfm_base.*, CAST(date_diff('day', CAST(LAST_PURCHASE_DATE AS DATE),
      CAST(today AS DATE)) AS INTEGER) AS RECENCY FROM rfm_base, now""",
    "rfm_ranked": """SELECT *, percent_rank() OVER (ORDER BY RECENCY NULLS FIRST) AS pr,
    percent_rank() OVER (ORDER BY FREQUENCY NULLS FIRST) AS pf,
    percent_rank() OVER (ORDER BY MONETARY NULLS FIRST) AS pm FROM rfm_recency""",
    "rfm_scored": f"""SELECT * EXCLUDE (pr, pf, pm), {_score('pr', False)} AS R_SCORE,
    {_score('pf', True)} AS F_SCORE, {_score('pm', True)} AS M_SCORE FROM rfm_ranked""",
    "rfm_gold": """SELECT *, R_SCORE || '' || F_SCORE || M_SCORE AS RFM_SCORE,
    CASE WHEN R_SCORE >= 4 AND F_SCORE >= 4 AND M_SCORE >= 4 THEN 'VIP'
    WHEN R_SCORE >= 4 AND F_SCORE <= 2 THEN 'New Customer'
    WHEN R_SCORE <= 2 AND F_SCORE <= 2 THEN 'Churn Risk'
    ELSE 'Regular Customer' END AS CUSTOMER_SEGMENT FROM rfm_scored""",
    "last_orders": """SELECT CUSTOMER_ID, max(CREATION_TIME_UTC) AS LAST_ORDER_DATE,
    CAST(date_diff('day', CAST(max(CREATION_TIME_UTC) AS DATE), CAST(any_value(today) AS DATE))
      AS INTEGER) AS DAYS_SINCE_LAST_ORDER FROM buyers, now GROUP BY 1""",
    "gaps": """SELECT CUSTOMER_ID, ORDER_ID, LINEITEM_ID, CREATION_TIME_UTC,
    lag(CREATION_TIME_UTC) OVER w AS PREVIOUS_ORDER_DATE,
    CAST(date_diff('day', CAST(lag(CREATION_TIME_UTC) OVER w AS DATE),
      CAST(CREATION_TIME_UTC AS DATE)) AS INTEGER) AS ORDER_GAP_DAYS
    FROM buyers WINDOW w AS (PARTITION BY CUSTOMER_ID
      ORDER BY CREATION_TIME_UTC NULLS FIRST, ORDER_ID NULLS FIRST, LINEITEM_ID NULLS FIRST)""",
    "mean_gaps": """SELECT CUSTOMER_ID,
    CAST(sum(ORDER_GAP_DAYS) AS DOUBLE) / nullif(count(ORDER_GAP_DAYS), 0) AS AVG_ORDER_GAP_DAYS
    FROM gaps GROUP BY 1""",
    "order_times": """SELECT CUSTOMER_ID, ORDER_ID, min(CREATION_TIME_UTC) AS ordered
    FROM buyers GROUP BY 1, 2""",
    "order_gap_rows": """SELECT CUSTOMER_ID, date_diff('day', CAST(lag(ordered) OVER (
      PARTITION BY CUSTOMER_ID ORDER BY ordered NULLS FIRST) AS DATE), CAST(ordered AS DATE)) AS gap
    FROM order_times""",
    "mean_order_gaps": """SELECT CUSTOMER_ID,
    CAST(sum(gap) AS DOUBLE) / nullif(count(gap), 0) AS AVG_ORDER_GAP_DAYS
    FROM order_gap_rows GROUP BY 1""",
    "period_lines": """SELECT * FROM (SELECT buyers.*, CAST(date_diff('day',
      CAST(CREATION_TIME_UTC AS DATE), CAST(today AS DATE)) AS INTEGER) AS DAYS_FROM_REFERENCE,
      CASE WHEN DAYS_FROM_REFERENCE <= 90 THEN 'RECENT'
        WHEN DAYS_FROM_REFERENCE <= 180 THEN 'PREVIOUS' END AS SPEND_PERIOD FROM buyers, now)
    WHERE SPEND_PERIOD IS NOT NULL""",
    "period_spend": """SELECT CUSTOMER_ID,
    coalesce(sum(REVENUE) FILTER (SPEND_PERIOD = 'PREVIOUS'), 0) AS PREVIOUS_SPEND,
    coalesce(sum(REVENUE) FILTER (SPEND_PERIOD = 'RECENT'), 0) AS RECENT_SPEND
    FROM period_lines GROUP BY 1""",
    "spend_moves": """SELECT *, CASE WHEN PREVIOUS_SPEND > 0
    THEN CAST(RECENT_SPEND - PREVIOUS_SPEND AS DOUBLE) / CAST(PREVIOUS_SPEND AS DOUBLE) * 100.0
    ELSE 0.0 END AS SPEND_CHANGE_PERCENT FROM period_spend""",
    "churn_gold": """SELECT l.*, AVG_ORDER_GAP_DAYS, PREVIOUS_SPEND, RECENT_SPEND,
    SPEND_CHANGE_PERCENT, CASE WHEN DAYS_SINCE_LAST_ORDER > 90 THEN 'High Risk'
      WHEN DAYS_SINCE_LAST_ORDER > 45 THEN 'At Risk' ELSE 'Active' END AS CHURN_STATUS
    FROM last_orders l LEFT JOIN mean_gaps USING (CUSTOMER_ID)
    LEFT JOIN spend_moves USING (CUSTOMER_ID)""",
    "loyalty": """SELECT CUSTOMER_ID, IS_LOYALTY, sum(REVENUE) AS TOTAL_SPEND,
    count(DISTINCT ORDER_ID) AS TOTAL_ORDERS FROM buyers GROUP BY 1, 2""",
    "loyalty_gold": f"""SELECT *, {ratio('TOTAL_SPEND', 'TOTAL_ORDERS')} AS AVG_ORDER_VALUE,
    CASE WHEN IS_LOYALTY THEN 'LOYALTY_MEMBER' ELSE 'NON_LOYALTY_MEMBER' END AS LOYALTY_STATUS,
    TOTAL_SPEND AS LIFETIME_VALUE FROM loyalty""",
    "sales_gold": f"""SELECT *, {ratio('TOTAL_REVENUE', 'TOTAL_ORDERS')} AS AVG_ORDER_VALUE FROM (
    {DAILY} UNION ALL {WEEKLY} UNION ALL {MONTHLY})""",
    "sales_iso_gold": f"""SELECT *, {ratio('TOTAL_REVENUE', 'TOTAL_ORDERS')} AS AVG_ORDER_VALUE
    FROM ({DAILY} UNION ALL {WEEKLY_ISO} UNION ALL {MONTHLY})""",
    "locations": _locations(TIME),
    "locations_by_day": _locations(f"CAST({TIME} AS DATE)"),
    "locations_gold": f"""SELECT *, {LOCATION_RATES},
    dense_rank() OVER (ORDER BY TOTAL_REVENUE DESC NULLS LAST) AS REVENUE_RANK FROM locations""",
    "discounts": """SELECT ORDER_ID, round(sum(OPTION_PRICE * -1), 2) AS DISCOUNT_AMOUNT
    FROM options WHERE OPTION_PRICE < 0 GROUP BY 1""",
    "discounts_by_quantity": """SELECT ORDER_ID,
    round(sum(OPTION_PRICE * -1 * OPTION_QUANTITY), 2) AS DISCOUNT_AMOUNT
    FROM options WHERE OPTION_PRICE < 0 GROUP BY 1""",
    "gross": """SELECT ORDER_ID, round(sum(ITEM_PRICE * ITEM_QUANTITY), 2) AS GROSS_REVENUE
    FROM items GROUP BY 1""",
    "priced_orders": """SELECT ORDER_ID, GROSS_REVENUE,
    coalesce(DISCOUNT_AMOUNT, 0) AS DISCOUNT_AMOUNT,
    CASE WHEN coalesce(DISCOUNT_AMOUNT, 0) > 0 THEN 'DISCOUNTED_ORDER'
      ELSE 'NON_DISCOUNTED_ORDER' END AS DISCOUNT_STATUS,
    round(GROSS_REVENUE - coalesce(DISCOUNT_AMOUNT, 0), 2) AS NET_REVENUE
    FROM gross LEFT JOIN discounts USING (ORDER_ID)""",
    "pricing": """SELECT DISCOUNT_STATUS, count(DISTINCT ORDER_ID) AS TOTAL_ORDERS,
    sum(GROSS_REVENUE) AS GROSS_REVENUE, sum(DISCOUNT_AMOUNT) AS DISCOUNT_AMOUNT,
    sum(NET_REVENUE) AS NET_REVENUE FROM priced_orders GROUP BY 1""",
    "pricing_gold": f"""SELECT *,
    round({ratio('NET_REVENUE', 'TOTAL_ORDERS')}, 2) AS AVG_ORDER_VALUE,
    round({ratio('NET_REVENUE', 'sum(NET_REVENUE) OVER ()')} * 100, 2) AS REVENUE_PERCENTAGE
    FROM pricing""",
    "line_discounts": """SELECT ORDER_ID, LINEITEM_ID, sum(OPTION_PRICE * -1) AS cut
    FROM options WHERE OPTION_PRICE < 0 GROUP BY 1, 2""",
    "line_nets": """SELECT i.*, i.ITEM_PRICE * i.ITEM_QUANTITY - coalesce(cut, 0) AS net,
    CASE WHEN coalesce(DISCOUNT_AMOUNT, 0) > 0 THEN 'DISCOUNTED_ORDER'
      ELSE 'NON_DISCOUNTED_ORDER' END AS DISCOUNT_STATUS
    FROM items i LEFT JOIN line_discounts USING (ORDER_ID, LINEITEM_ID)
    LEFT JOIN discounts USING (ORDER_ID)""",
    "spread": """SELECT CAST(min(DAYS_SINCE_LAST_ORDER) AS DOUBLE) AS low,
    CAST(max(DAYS_SINCE_LAST_ORDER) AS DOUBLE) AS high FROM churn_gold""",
    "gap_places": """SELECT CHURN_STATUS, AVG_ORDER_GAP_DAYS AS x,
    row_number() OVER (PARTITION BY CHURN_STATUS ORDER BY AVG_ORDER_GAP_DAYS) - 1 AS place,
    count(*) OVER (PARTITION BY CHURN_STATUS) - 1 AS final
    FROM churn_gold WHERE AVG_ORDER_GAP_DAYS IS NOT NULL""",
    "days_off": """SELECT min(d) AS FIRST_DAY, max(d) AS LAST_DAY, CAST(count(*) AS INTEGER) AS DAYS FROM (
      SELECT d, d - CAST(row_number() OVER (ORDER BY d) AS INTEGER) AS island FROM (
        SELECT DISTINCT date_key AS d FROM dates WHERE date_key IS NOT NULL AND (is_weekend OR is_holiday)))
    GROUP BY island""",
    "streaks": f"""SELECT RESTAURANT_ID, min(d) AS STREAK_FIRST, max(d) AS STREAK_LAST,
    CAST(count(*) AS INTEGER) AS STREAK_DAYS FROM (
      SELECT RESTAURANT_ID, d, d - CAST(row_number() OVER (PARTITION BY RESTAURANT_ID ORDER BY d) AS INTEGER)
        AS island FROM (SELECT DISTINCT RESTAURANT_ID, CAST({TIME} AS DATE) AS d FROM items WHERE {TIME} IS NOT NULL))
    GROUP BY RESTAURANT_ID, island""",
    "visits": """SELECT RESTAURANT_ID, CUSTOMER_ID, count(DISTINCT ORDER_ID) AS n
    FROM buyers GROUP BY 1, 2""",
}
_WORD = re.compile(r"[A-Za-z_]+")


def with_steps(select: str) -> str:
    """Put the steps a SELECT needs, and the steps those need, in front of it."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for word in dict.fromkeys(_WORD.findall(re.sub(r"'[^']*'", "", text))):
            if word in STEPS and word not in needed:
                visit(STEPS[word])
                if word not in needed:
                    needed.append(word)

    visit(select)
    if not needed:
        return select
    return "WITH " + ",\n".join(f"{n} AS ({STEPS[n]})" for n in needed) + "\n" + select


def _quantile(q: float, name: str) -> str:
    low = f"max(x) FILTER (place = floor(final * {q}))"
    high = f"max(x) FILTER (place = ceil(final * {q}))"
    part = f"(max(final) * {q} - floor(max(final) * {q}))"
    return f"{low} + ({high} - {low}) * {part} AS {name}"


def _mean(column: str, name: str) -> str:
    return f"{ratio(f'sum({column})', f'count({column})')} AS {name}"


ITEMS_OUT = "* REPLACE (CAST(ITEM_PRICE AS DOUBLE) AS ITEM_PRICE)"
OPTIONS_OUT = "* REPLACE (CAST(OPTION_PRICE AS DOUBLE) AS OPTION_PRICE)"
SALES_OUT = "* REPLACE (CAST(TOTAL_REVENUE AS DOUBLE) AS TOTAL_REVENUE)"
RFM_OUT = "* REPLACE (CAST(MONETARY AS DOUBLE) AS MONETARY)"
CHURN_OUT = (
    "* REPLACE (CAST(PREVIOUS_SPEND AS DOUBLE) AS PREVIOUS_SPEND, "
    "CAST(RECENT_SPEND AS DOUBLE) AS RECENT_SPEND)"
)
LOYALTY_OUT = (
    "* REPLACE (CAST(TOTAL_SPEND AS DOUBLE) AS TOTAL_SPEND, "
    "CAST(LIFETIME_VALUE AS DOUBLE) AS LIFETIME_VALUE)"
)
PRICED = ("GROSS_REVENUE", "DISCOUNT_AMOUNT", "NET_REVENUE")
PRICING_OUT = "* REPLACE (" + ", ".join(dbl(c) for c in PRICED) + ")"
CUSTOMER_LINES = "CUSTOMER_ID, ORDER_ID, LINEITEM_ID"


def _null_count(column: str) -> str:
    return f"CAST(sum(CASE WHEN {column} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS {column}"


ALL_RAW_ITEMS = ["LINEITEM_ID", *RAW_ITEM_COLUMNS]
NULL_COUNTS = f"SELECT {', '.join(map(_null_count, ALL_RAW_ITEMS))} FROM raw_items"


def _saved_nulls(table: str, step: str, columns: list[str]) -> str:
    counts = f"SELECT {', '.join(map(_null_count, columns))} FROM {step}"
    return f"""SELECT '{table}' AS TABLE_NAME, column_name, null_count FROM ({counts})
        UNPIVOT (null_count FOR column_name IN ({', '.join(columns)}))"""


def _saved_duplicates(table: str, step: str, key: str) -> str:
    return f"""SELECT '{table}' AS TABLE_NAME, CAST({key} AS VARCHAR) AS KEY_VALUE, count(*) AS count
        FROM {step} GROUP BY {key} HAVING count(*) > 1"""


def _emptied(dataset: str, step: str, condition: str) -> str:
    return f"SELECT '{dataset}' AS DATASET WHERE (SELECT count(*) FROM {step} WHERE {condition}) = 0"


def _sales_total(column: str, name: str | None = None) -> str:
    kind = "DOUBLE" if "REVENUE" in column else "BIGINT"
    return f"CAST(coalesce(sum({column}), 0) AS {kind}) AS {name or column}"


QUERIES = {
    # Sources and sinks
    "extract_roundtrip": "SELECT * FROM raw_items",
    "bronze_promote": "SELECT * FROM raw_dates",
    "gold_replaced": f"SELECT {SALES_OUT} FROM sales_gold",
    "scan_parquet": "SELECT * FROM orders",
    "gold_roundtrip": f"SELECT {SALES_OUT} FROM sales_gold",
    "csv_ingest": "SELECT * FROM raw_options",
    "sanitize_columns": """SELECT l_orderkey AS order_key, l_partkey AS part_key, l_suppkey AS supp_key,
        l_linenumber AS line_number, l_quantity AS quantity, l_extendedprice AS price_extended,
        l_discount AS dis_count, l_tax AS tax, l_returnflag AS return_flag, l_linestatus AS status,
        l_shipdate AS ship_date FROM lineitem""",
    "csv_bad_cells": " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, {c} AS cell, count(*) AS count FROM raw_items
        WHERE trim({c}) <> '' AND TRY_CAST({c} AS {kind}) IS NULL GROUP BY 2"""
        for c, kind in {
            TIME: "TIMESTAMP", "ITEM_PRICE": "DOUBLE", "ITEM_QUANTITY": "DOUBLE", "IS_LOYALTY": "DOUBLE"
        }.items()
    ),
    "table_roundtrip": """SELECT ORDER_ID, count(*) AS count FROM raw_options
        GROUP BY 1 HAVING count(*) > 1""",
    "load_gold_sales": "SELECT * REPLACE (CAST(TOTAL_REVENUE AS DOUBLE) AS TOTAL_REVENUE, "
    "CAST(SALES_DATE AS TIMESTAMP) AS SALES_DATE) FROM sales_gold",
    "csv_inferred_items": """SELECT * REPLACE (CAST(ORDER_ID AS INTEGER) AS ORDER_ID,
        nullif(USER_ID, '') AS USER_ID) FROM raw_items""",
    "csv_inferred_options": """SELECT * REPLACE (CAST(ORDER_ID AS INTEGER) AS ORDER_ID,
        CAST(OPTION_PRICE AS DOUBLE) AS OPTION_PRICE,
        CAST(OPTION_QUANTITY AS DOUBLE) AS OPTION_QUANTITY) FROM raw_options""",
    "csv_inferred_dates": """SELECT * REPLACE (CAST(date_key AS TIMESTAMP) AS date_key,
        CAST(year AS INTEGER) AS year, CAST(month AS INTEGER) AS month, CAST(week AS INTEGER) AS week,
        CAST(is_weekend AS BOOLEAN) AS is_weekend, CAST(is_holiday AS BOOLEAN) AS is_holiday)
        FROM raw_dates""",
    "extract_options": "SELECT * FROM raw_options",
    "extract_dates": "SELECT * FROM raw_dates",
    "bronze_items": "SELECT * FROM raw_items",
    "bronze_options": "SELECT * FROM raw_options",
    "dataset_availability": " UNION ALL ".join(
        (
            _emptied("customer_segmentation", "rfm_gold", "FREQUENCY >= 1"),
            _emptied("customer_churn_indicators", "churn_gold", "DAYS_SINCE_LAST_ORDER < 0"),
            _emptied("sales_trends", "sales_gold", "TOTAL_ORDERS >= 1"),
            _emptied("loyalty_program_impact", "loyalty_gold", "TOTAL_ORDERS > 1000000"),
            _emptied("top_performing_locations", "locations_gold", "TOTAL_ORDERS >= 1"),
            _emptied("pricing_discount_effectiveness", "pricing_gold", "TOTAL_ORDERS = 0"),
        )
    ),
    "required_columns": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders",
    # Data quality
    "dq_duplicate_rows": """SELECT * FROM (SELECT *, count(*) AS count FROM raw_items
        GROUP BY ALL HAVING count(*) > 1)""",
    "dq_duplicate_rows_options": """SELECT * FROM (SELECT *, count(*) AS count FROM raw_options
        GROUP BY ALL HAVING count(*) > 1)""",
    "dq_duplicate_rows_dates": """SELECT * FROM (SELECT *, count(*) AS count FROM raw_dates
        GROUP BY ALL HAVING count(*) > 1)""",
    "dq_duplicate_keys": """SELECT ORDER_ID, count(*) AS duplicate_count FROM raw_options
        GROUP BY 1 HAVING count(*) > 1""",
    "dq_null_counts": NULL_COUNTS,
    "dq_null_summary": f"""SELECT column_name, null_count FROM ({NULL_COUNTS})
        UNPIVOT (null_count FOR column_name IN ({', '.join(ALL_RAW_ITEMS)}))""",
    "dq_saved_nulls": " UNION ALL ".join(
        (
            _saved_nulls("order_items", "raw_items", ALL_RAW_ITEMS),
            _saved_nulls("order_item_options", "raw_options", list(RAW_OPTION_COLUMNS)),
            _saved_nulls("date_dim", "raw_dates", ["date_key", *RAW_DATE_COLUMNS]),
        )
    ),
    "dq_saved_duplicates": " UNION ALL ".join(
        (
            _saved_duplicates("order_items", "raw_items", "LINEITEM_ID"),
            _saved_duplicates("order_item_options", "raw_options", "ORDER_ID"),
            _saved_duplicates("date_dim", "raw_dates", "date_key"),
        )
    ),
    # Silver
    "silver_dedupe_lineitems": "SELECT * FROM raw_items_once",
    "silver_trim": """SELECT LINEITEM_ID, trim(APP_NAME) AS APP_NAME,
        trim(RESTAURANT_ID) AS RESTAURANT_ID, trim(CURRENCY) AS CURRENCY,
        trim(ITEM_CATEGORY) AS ITEM_CATEGORY, trim(ITEM_NAME) AS ITEM_NAME FROM raw_items""",
    "silver_casts": """SELECT ORDER_ID, LINEITEM_ID,
        CAST(CAST(OPTION_PRICE AS DECIMAL(10,2)) AS DOUBLE) AS OPTION_PRICE,
        CAST(CAST(OPTION_QUANTITY AS DOUBLE) AS INTEGER) AS OPTION_QUANTITY FROM raw_options""",
    "silver_casts_items": r"""SELECT LINEITEM_ID, ORDER_ID,
        CAST(TRY_CAST(ITEM_PRICE AS DECIMAL(10,2)) AS DOUBLE) AS ITEM_PRICE,
        TRY_CAST(regexp_replace(ITEM_QUANTITY, '\.\d*\s*$', '') AS INTEGER) AS ITEM_QUANTITY FROM raw_items""",
    "silver_loyalty_flag": """SELECT LINEITEM_ID,
        coalesce(TRY_CAST(IS_LOYALTY AS DOUBLE) = 1, false) AS IS_LOYALTY FROM raw_items""",
    "silver_id_status": """SELECT LINEITEM_ID, USER_ID,
        trim(PRINTED_CARD_NUMBER) AS PRINTED_CARD_NUMBER,
        CASE WHEN coalesce(trim(USER_ID), '') = '' THEN 'MISSING_USER_ID'
          ELSE 'VALID_USER_ID' END AS USER_ID_STATUS,
        CASE WHEN coalesce(trim(PRINTED_CARD_NUMBER), '') = '' THEN 'MISSING_CARD_NUMBER'
          ELSE 'VALID_CARD_NUMBER' END AS CARD_NUMBER_STATUS FROM raw_items""",
    "silver_valid_lines": """SELECT LINEITEM_ID, ITEM_QUANTITY FROM (SELECT LINEITEM_ID,
        TRY_CAST(regexp_replace(ITEM_QUANTITY, '\\.\\d*\\s*$', '') AS INTEGER) AS ITEM_QUANTITY
        FROM raw_items) WHERE ITEM_QUANTITY > 0""",
    "silver_order_items": f"SELECT {ITEMS_OUT} FROM items",
    "silver_merged": f"SELECT {ITEMS_OUT} FROM items",
    "silver_options": f"SELECT {OPTIONS_OUT} FROM options",
    "silver_date_dim": "SELECT * FROM dates",
    # Building blocks
    "unified_customer": f"SELECT {CUSTOMER_LINES} FROM buyers",
    "unified_customer_fixed": f"SELECT {CUSTOMER_LINES} FROM buyers_fixed",
    "line_revenue": f"SELECT LINEITEM_ID, {dbl('ITEM_PRICE * ITEM_QUANTITY', 'LINE_REVENUE')} FROM items",
    "option_revenue": f"SELECT ORDER_ID, LINEITEM_ID, {dbl('OPTION_REVENUE')} FROM line_options",
    "order_line_revenue": f"""SELECT ORDER_ID, LINEITEM_ID, {dbl('ITEM_REVENUE')},
        {dbl('OPTION_REVENUE')}, {dbl('TOTAL_LINE_REVENUE')} FROM line_totals""",
    "reference_date": "SELECT today AS REFERENCE_DATE FROM now",
    "days_since": """SELECT LINEITEM_ID, CAST(date_diff('day', CAST(CREATION_TIME_UTC AS DATE),
        CAST(today AS DATE)) AS INTEGER) AS DAYS FROM buyers, now""",
    "global_percent_rank": """SELECT o_orderkey, o_totalprice,
        percent_rank() OVER (ORDER BY o_totalprice NULLS FIRST) AS PERCENT_RANK FROM orders""",
    # Lifetime value
    "clv_totals": f"SELECT CUSTOMER_ID, {dbl('CUSTOMER_LIFETIME_VALUE')} FROM clv",
    "clv_percent_rank": f"""SELECT CUSTOMER_ID, {dbl('CUSTOMER_LIFETIME_VALUE')}, PERCENT_RANK
        FROM clv_ranked""",
    "clv_segments": f"""SELECT CUSTOMER_ID, {dbl('CUSTOMER_LIFETIME_VALUE')}, PERCENT_RANK,
        CLV_SEGMENT FROM clv_gold""",
    # Segmentation
    "rfm_base": f"SELECT {RFM_OUT} FROM rfm_base",
    "rfm_recency": f"SELECT {RFM_OUT} FROM rfm_recency",
    "rfm_scores": f"""SELECT CUSTOMER_ID, RECENCY, FREQUENCY, {dbl('MONETARY')}, R_SCORE, F_SCORE,
        M_SCORE, RFM_SCORE FROM rfm_gold""",
    "rfm_segments": f"SELECT {RFM_OUT} FROM rfm_gold",
    # Churn
    "churn_last_order": "SELECT * FROM last_orders",
    "churn_order_gaps": "SELECT * FROM gaps",
    "churn_avg_gap": "SELECT * FROM mean_gaps",
    "churn_avg_gap_fixed": "SELECT * FROM mean_order_gaps",
    "churn_spend_periods": f"""SELECT {CUSTOMER_LINES}, {dbl('REVENUE', 'ORDER_REVENUE')},
        DAYS_FROM_REFERENCE, SPEND_PERIOD FROM period_lines""",
    "churn_spend_pivot": f"SELECT {CHURN_OUT} FROM period_spend",
    "churn_spend_change": f"SELECT {CHURN_OUT} FROM spend_moves",
    "churn_indicators": f"SELECT {CHURN_OUT} FROM churn_gold",
    # Loyalty
    "loyalty_base": f"SELECT CUSTOMER_ID, IS_LOYALTY, {dbl('TOTAL_SPEND')}, TOTAL_ORDERS FROM loyalty",
    "loyalty_before_orders": f"""SELECT o.CUSTOMER_ID, ORDER_ID, FIRST_TIME, LOYAL AS LOYALTY_BEFORE
        FROM (SELECT CUSTOMER_ID, ORDER_ID, min({TIME}) AS FIRST_TIME FROM buyers GROUP BY 1, 2) o
        ASOF LEFT JOIN (SELECT CUSTOMER_ID, {TIME} AS SINCE, bool_or(IS_LOYALTY) AS LOYAL
            FROM buyers WHERE {TIME} IS NOT NULL GROUP BY 1, 2) s
        ON o.CUSTOMER_ID = s.CUSTOMER_ID AND o.FIRST_TIME > s.SINCE""",
    "loyalty_impact": f"SELECT {LOYALTY_OUT} FROM loyalty_gold",
    # Sales
    "sales_date_parts": f"""SELECT LINEITEM_ID, CAST({TIME} AS DATE) AS SALES_DATE,
        CAST(year({TIME}) AS INTEGER) AS YEAR, CAST(month({TIME}) AS INTEGER) AS MONTH,
        CAST(week({TIME}) AS INTEGER) AS WEEK FROM items""",
    "sales_time_of_day": f"SELECT LINEITEM_ID, {TIME_OF_DAY} AS TIME_OF_DAY FROM items",
    "sales_daily": f"SELECT {SALES_OUT.replace('*', '* EXCLUDE (YEAR, WEEK, MONTH)')} FROM ({DAILY})",
    "sales_weekly": f"SELECT {SALES_OUT.replace('*', '* EXCLUDE (SALES_DATE, MONTH)')} FROM ({WEEKLY})",
    "sales_weekly_fixed": f"""SELECT {SALES_OUT.replace('*', '* EXCLUDE (SALES_DATE, MONTH)')}
        FROM ({WEEKLY_ISO})""",
    "sales_monthly": f"SELECT {SALES_OUT.replace('*', '* EXCLUDE (SALES_DATE, WEEK)')} FROM ({MONTHLY})",
    "sales_trends": f"SELECT {SALES_OUT} FROM sales_gold",
    "sales_trends_fixed": f"SELECT {SALES_OUT} FROM sales_iso_gold",
    "sales_orders_total": "SELECT count(DISTINCT ORDER_ID) AS TOTAL_ORDERS FROM items",
    "sales_orders_by_restaurant": """SELECT RESTAURANT_ID, count(DISTINCT ORDER_ID) AS TOTAL_ORDERS
        FROM items GROUP BY 1""",
    "sales_orders_by_month_category": f"""SELECT CAST(year({TIME}) AS INTEGER) AS YEAR,
        CAST(month({TIME}) AS INTEGER) AS MONTH, ITEM_CATEGORY, count(DISTINCT ORDER_ID) AS TOTAL_ORDERS
        FROM items GROUP BY ALL""",
    "sales_orders_sketched": f"""SELECT RESTAURANT_ID, {dbl('sum(ITEM_PRICE * ITEM_QUANTITY)', 'TOTAL_REVENUE')},
        CAST(sum(ITEM_QUANTITY) AS BIGINT) AS ITEMS_SOLD, true AS NEAR FROM items GROUP BY 1""",
    "sales_cube": f"""SELECT ITEM_CATEGORY, RESTAURANT_ID, SALES_MONTH,
        CAST(GROUPING_ID(ITEM_CATEGORY, RESTAURANT_ID, SALES_MONTH) AS BIGINT) AS GROUPING_ID,
        {dbl('sum(ITEM_PRICE * ITEM_QUANTITY)', 'TOTAL_REVENUE')}, CAST(sum(ITEM_QUANTITY) AS BIGINT) AS ITEMS_SOLD,
        count(DISTINCT ORDER_ID) AS TOTAL_ORDERS
        FROM (SELECT *, CAST(date_trunc('month', {TIME}) AS DATE) AS SALES_MONTH FROM items)
        GROUP BY CUBE (ITEM_CATEGORY, RESTAURANT_ID, SALES_MONTH)""",
    "sales_by_calendar": f"""SELECT is_weekend, is_holiday,
        {dbl('sum(ITEM_PRICE * ITEM_QUANTITY)', 'TOTAL_REVENUE')},
        count(DISTINCT ORDER_ID) AS TOTAL_ORDERS, CAST(sum(ITEM_QUANTITY) AS BIGINT) AS ITEMS_SOLD
        FROM items LEFT JOIN (SELECT DISTINCT ON (date_key) * FROM dates WHERE date_key IS NOT NULL
          ORDER BY date_key) ON CAST({TIME} AS DATE) = date_key GROUP BY 1, 2""",
    "sales_by_days_off": f"""SELECT FIRST_DAY, LAST_DAY, DAYS,
        CAST(coalesce(sum(ITEM_PRICE * ITEM_QUANTITY), 0) AS DOUBLE) AS TOTAL_REVENUE,
        count(DISTINCT ORDER_ID) AS TOTAL_ORDERS
        FROM days_off LEFT JOIN items ON CAST({TIME} AS DATE) BETWEEN FIRST_DAY AND LAST_DAY GROUP BY 1, 2, 3""",
    "streaks_on_days_off": """SELECT *, CAST(date_diff('day', greatest(STREAK_FIRST, FIRST_DAY),
        least(STREAK_LAST, LAST_DAY)) + 1 AS INTEGER) AS DAYS_SHARED
        FROM streaks JOIN days_off ON STREAK_FIRST <= LAST_DAY AND FIRST_DAY <= STREAK_LAST""",
    "spend_before_orders": f"""SELECT CUSTOMER_ID, ORDER_ID, ORDER_DAY, {dbl('ROLLING_SPEND')}
        FROM (SELECT DISTINCT CUSTOMER_ID, ORDER_ID, CAST({TIME} AS DATE) AS ORDER_DAY FROM buyers)
        LEFT JOIN (SELECT CUSTOMER_ID, ORDER_DAY, sum(spent) OVER (PARTITION BY CUSTOMER_ID ORDER BY ORDER_DAY
            RANGE BETWEEN INTERVAL 89 DAYS PRECEDING AND CURRENT ROW) AS ROLLING_SPEND
          FROM (SELECT CUSTOMER_ID, CAST({TIME} AS DATE) AS ORDER_DAY, sum(REVENUE) AS spent FROM buyers
            WHERE {TIME} IS NOT NULL GROUP BY 1, 2)) USING (CUSTOMER_ID, ORDER_DAY)""",
    # Locations
    "location_metrics": f"SELECT {SALES_OUT}, {LOCATION_RATES} FROM locations",
    "location_metrics_fixed": f"SELECT {SALES_OUT}, {LOCATION_RATES} FROM locations_by_day",
    "location_ranking": f"SELECT {SALES_OUT} FROM locations_gold",
    "location_retention": f"""SELECT RESTAURANT_ID, count(*) AS CUSTOMERS,
        count(*) FILTER (n >= 2) AS RETURNING,
        {ratio('count(*) FILTER (n >= 2)', 'count(*)')} * 100.0 AS CUSTOMER_RETENTION_RATE
        FROM visits GROUP BY 1""",
    # Pricing
    "pricing_order_discounts": f"SELECT ORDER_ID, {dbl('DISCOUNT_AMOUNT')} FROM discounts",
    "pricing_order_discounts_fixed": f"""SELECT ORDER_ID, {dbl('DISCOUNT_AMOUNT')}
        FROM discounts_by_quantity""",
    "pricing_order_gross": f"SELECT ORDER_ID, {dbl('GROSS_REVENUE')} FROM gross",
    "pricing_orders": f"SELECT {PRICING_OUT} FROM priced_orders",
    "pricing_effectiveness": f"SELECT {PRICING_OUT} FROM pricing_gold",
    "pricing_by_category": f"""SELECT ITEM_CATEGORY, DISCOUNT_STATUS,
        {dbl('sum(net)', 'NET_REVENUE')} FROM line_nets GROUP BY 1, 2""",
    "pricing_by_restaurant": f"""SELECT RESTAURANT_ID, DISCOUNT_STATUS,
        {dbl('sum(net)', 'NET_REVENUE')} FROM line_nets GROUP BY 1, 2""",
    # Reports
    "report_filter_in": f"SELECT {SALES_OUT} FROM sales_gold WHERE SALES_PERIOD IN ('DAILY', 'MONTHLY') "
    "AND RESTAURANT_ID IS NOT NULL",
    "report_filter_keep_null": f"SELECT {SALES_OUT} FROM sales_gold WHERE MONTH IN (1, 2) OR MONTH IS NULL",
    "report_choices": "SELECT DISTINCT RESTAURANT_ID FROM sales_gold WHERE RESTAURANT_ID IS NOT NULL",
    "report_date_range": "SELECT * REPLACE (CAST(TOTAL_REVENUE AS DOUBLE) AS TOTAL_REVENUE, "
    "CAST(SALES_DATE AS TIMESTAMP) AS SALES_DATE) FROM sales_gold "
    "WHERE SALES_DATE BETWEEN DATE '1996-03-01' AND DATE '1998-06-30'",
    "report_exec_kpis": f"""SELECT (SELECT count(DISTINCT CUSTOMER_ID) FROM rfm_gold)
        AS TOTAL_CUSTOMERS, {_sales_total('TOTAL_REVENUE')}, {_sales_total('TOTAL_ORDERS')},
        (SELECT count(*) FROM churn_gold WHERE CHURN_STATUS = 'AT_RISK') AS CUSTOMERS_AT_RISK
        FROM sales_gold""",
    "report_exec_kpis_fixed": f"""SELECT (SELECT count(DISTINCT CUSTOMER_ID) FROM rfm_gold)
        AS TOTAL_CUSTOMERS, {dbl('sum(ITEM_PRICE * ITEM_QUANTITY)', 'TOTAL_REVENUE')},
        count(DISTINCT ORDER_ID) AS TOTAL_ORDERS,
        (SELECT count(*) FROM churn_gold WHERE CHURN_STATUS IN ('At Risk', 'High Risk'))
        AS CUSTOMERS_AT_RISK FROM items""",
    "report_seg_kpis": f"""SELECT count(DISTINCT CUSTOMER_ID) AS TOTAL_CUSTOMERS,
        {_mean('MONETARY', 'AVERAGE_SPEND')}, {_mean('FREQUENCY', 'AVERAGE_ORDERS')},
        {_mean('RECENCY', 'AVERAGE_RECENCY')} FROM rfm_gold""",
    "report_segment_counts": """SELECT CUSTOMER_SEGMENT, count(*) AS CUSTOMER_COUNT FROM rfm_gold
        GROUP BY 1""",
    "report_segment_summary": f"""SELECT CUSTOMER_SEGMENT, {_mean('RECENCY', 'Average_Recency')},
        {_mean('FREQUENCY', 'Average_Frequency')}, {_mean('MONETARY', 'Average_Monetary')},
        count(RFM_SCORE) AS Average_RFM_Score FROM rfm_gold GROUP BY 1""",
    "report_segment_long": f"""SELECT CUSTOMER_SEGMENT, Metric, Value FROM (
        SELECT CUSTOMER_SEGMENT, {_mean('RECENCY', 'Average_Recency')},
        {_mean('FREQUENCY', 'Average_Frequency')}, {_mean('MONETARY', 'Average_Monetary')}
        FROM rfm_gold GROUP BY 1)
        UNPIVOT (Value FOR Metric IN (Average_Recency, Average_Frequency, Average_Monetary))""",
    "report_rfm_histogram": """SELECT RFM_SCORE, CUSTOMER_SEGMENT, count(*) AS CUSTOMER_COUNT
        FROM rfm_gold GROUP BY 1, 2""",
    "report_top_customers": f"""SELECT CUSTOMER_ID, {dbl('MONETARY')}, FREQUENCY, RECENCY, RFM_SCORE,
        CUSTOMER_SEGMENT, IS_LOYALTY FROM rfm_gold
        ORDER BY rfm_gold.MONETARY DESC NULLS LAST, CUSTOMER_ID LIMIT 20""",
    "report_loyalty_comparison": f"""SELECT IS_LOYALTY, {_mean('MONETARY', 'Average_Spend')},
        {_mean('FREQUENCY', 'Average_Frequency')}, {_mean('RECENCY', 'Average_Recency')}
        FROM rfm_gold WHERE IS_LOYALTY IS NOT NULL GROUP BY 1""",
    "report_churn_kpis": f"""SELECT count(DISTINCT CUSTOMER_ID) AS CUSTOMERS_ANALYZED,
        count(*) FILTER (contains(lower(CHURN_STATUS), 'risk')) AS AT_RISK_CUSTOMERS,
        round({ratio('sum(DAYS_SINCE_LAST_ORDER)', 'count(DAYS_SINCE_LAST_ORDER)')}, 1)
        AS AVG_DAYS_SINCE_LAST_ORDER FROM churn_gold""",
    "report_churn_counts": "SELECT CHURN_STATUS, count(*) AS CUSTOMERS FROM churn_gold GROUP BY 1",
    "report_inactivity_hist": """SELECT CAST(bin AS INTEGER) AS BIN,
        low + bin * ((high - low) / 40) AS BIN_START,
        low + (bin + 1) * ((high - low) / 40) AS BIN_END, CUSTOMERS FROM (
          SELECT least(floor((DAYS_SINCE_LAST_ORDER - low) * 40 / (high - low)), 39) AS bin,
          low, high, count(*) AS CUSTOMERS FROM churn_gold, spread GROUP BY ALL)""",
    "report_gap_box": f"""SELECT CHURN_STATUS, min(x) AS MINIMUM, {_quantile(0.25, 'Q1')},
        {_quantile(0.5, 'MEDIAN')}, {_quantile(0.75, 'Q3')}, max(x) AS MAXIMUM
        FROM gap_places GROUP BY 1""",
    "report_gap_quantiles": """SELECT CHURN_STATUS, count(AVG_ORDER_GAP_DAYS) AS ROWS, min(AVG_ORDER_GAP_DAYS) AS LEAST,
        max(AVG_ORDER_GAP_DAYS) AS MOST, true AS NEAR FROM churn_gold
        WHERE CHURN_STATUS IS NOT NULL GROUP BY 1 HAVING count(AVG_ORDER_GAP_DAYS) > 0""",
    "report_churn_scatter": """SELECT CUSTOMER_ID, DAYS_SINCE_LAST_ORDER, SPEND_CHANGE_PERCENT,
        CHURN_STATUS FROM churn_gold""",
    "report_retention_targets": f"""SELECT {CHURN_OUT} FROM churn_gold
        ORDER BY DAYS_SINCE_LAST_ORDER DESC NULLS LAST, SPEND_CHANGE_PERCENT ASC NULLS LAST,
        CUSTOMER_ID LIMIT 50""",
    "report_churn_spend": f"""SELECT {ratio('sum(MONETARY)', 'count(MONETARY)')}
        AS AVERAGE_CUSTOMER_SPEND FROM churn_gold LEFT JOIN rfm_base USING (CUSTOMER_ID)""",
    "report_sales_kpis": f"""SELECT {_sales_total('TOTAL_REVENUE')}, {_sales_total('TOTAL_ORDERS')},
        {_sales_total('ITEMS_SOLD')}, round(avg(AVG_ORDER_VALUE), 6) AS AVG_ORDER_VALUE
        FROM sales_gold""",
    "report_sales_kpis_fixed": f"""SELECT {dbl('sum(ITEM_PRICE * ITEM_QUANTITY)', 'TOTAL_REVENUE')},
        count(DISTINCT ORDER_ID) AS TOTAL_ORDERS, CAST(sum(ITEM_QUANTITY) AS BIGINT) AS ITEMS_SOLD,
        {ratio('sum(ITEM_PRICE * ITEM_QUANTITY)', 'count(DISTINCT ORDER_ID)')} AS AVG_ORDER_VALUE
        FROM items""",
    "report_monthly_revenue": f"""SELECT YEAR, MONTH, {_sales_total('TOTAL_REVENUE')},
        YEAR || '-' || MONTH AS PERIOD FROM sales_gold
        WHERE YEAR IS NOT NULL AND MONTH IS NOT NULL GROUP BY YEAR, MONTH""",
    "report_category_revenue": f"""SELECT ITEM_CATEGORY, {_sales_total('TOTAL_REVENUE')}
        FROM sales_gold WHERE ITEM_CATEGORY IS NOT NULL GROUP BY 1""",
    "report_top_restaurants": f"""SELECT RESTAURANT_ID, {dbl('revenue', 'TOTAL_REVENUE')} FROM (
        SELECT RESTAURANT_ID, sum(TOTAL_REVENUE) AS revenue FROM sales_gold
        WHERE RESTAURANT_ID IS NOT NULL GROUP BY 1)
        ORDER BY revenue DESC NULLS LAST, RESTAURANT_ID LIMIT 20""",
    "report_time_of_day": f"""SELECT TIME_OF_DAY, {_sales_total('TOTAL_REVENUE')} FROM sales_gold
        GROUP BY 1""",
    "report_loyalty_kpis": f"""SELECT count(DISTINCT CUSTOMER_ID) AS CUSTOMERS,
        {dbl('sum(TOTAL_SPEND)', 'TOTAL_REVENUE')}, {_mean('TOTAL_SPEND', 'AVG_CUSTOMER_SPEND')},
        round({ratio('sum(TOTAL_ORDERS)', 'count(TOTAL_ORDERS)')}, 2) AS AVG_ORDERS_PER_CUSTOMER
        FROM loyalty_gold""",
    "report_loyalty_summary": f"""SELECT LOYALTY_STATUS, count(DISTINCT CUSTOMER_ID) AS CUSTOMERS,
        {_mean('TOTAL_SPEND', 'AVG_SPEND')}, {_mean('LIFETIME_VALUE', 'AVG_LTV')},
        {_mean('TOTAL_ORDERS', 'AVG_REPEAT_ORDERS')}, {dbl('sum(TOTAL_SPEND)', 'REVENUE')}
        FROM loyalty_gold GROUP BY 1""",
    "report_loyalty_shares": f"""SELECT LOYALTY_STATUS,
        {ratio('c', 'sum(c) OVER ()')} AS CUSTOMER_SHARE,
        {ratio('r', 'sum(r) OVER ()')} AS REVENUE_SHARE FROM (
          SELECT LOYALTY_STATUS, count(DISTINCT CUSTOMER_ID) AS c, sum(TOTAL_SPEND) AS r
          FROM loyalty_gold GROUP BY 1)""",
    "report_loyalty_detail": f"SELECT {LOYALTY_OUT} FROM loyalty_gold",
    "report_coerce_numeric": """SELECT RESTAURANT_ID, CAST(TOTAL_REVENUE AS DOUBLE) AS TOTAL_REVENUE,
        CASE WHEN TOTAL_ORDERS % 7 <> 0 THEN CAST(TOTAL_ORDERS AS DOUBLE) END AS TOTAL_ORDERS,
        ORDERS_PER_DAY, ORDERS_PER_WEEK, AVG_ORDER_VALUE FROM locations_gold""",
    "report_location_kpis": f"""SELECT count(DISTINCT RESTAURANT_ID) AS LOCATIONS,
        {_sales_total('TOTAL_REVENUE')}, {_sales_total('TOTAL_ORDERS')},
        round(avg(AVG_ORDER_VALUE), 6) AS AVG_ORDER_VALUE FROM locations_gold""",
    "report_location_kpis_weighted": f"""SELECT count(DISTINCT RESTAURANT_ID) AS LOCATIONS,
        {_sales_total('TOTAL_REVENUE')}, {_sales_total('TOTAL_ORDERS')},
        {ratio('sum(TOTAL_REVENUE)', 'sum(TOTAL_ORDERS)')} AS AVG_ORDER_VALUE FROM locations_gold""",
    "report_location_rankings": f"""SELECT {SALES_OUT} FROM locations_gold
        ORDER BY locations_gold.TOTAL_REVENUE DESC NULLS LAST, RESTAURANT_ID LIMIT 10""",
    "report_location_revenue_ranking": f"SELECT {SALES_OUT} FROM locations_gold",
    "report_location_order_values": f"SELECT {SALES_OUT} FROM locations_gold",
    "report_location_volume": f"""SELECT RESTAURANT_ID, TOTAL_ORDERS, {dbl('TOTAL_REVENUE')},
        coalesce(AVG_ORDER_VALUE, 0) AS AVG_ORDER_VALUE FROM locations_gold""",
    "report_location_activity": """SELECT RESTAURANT_ID, ORDERS_PER_DAY, ORDERS_PER_WEEK
        FROM locations_gold""",
    "report_pricing_kpis": f"""SELECT {', '.join(dbl(f'sum({c})', c) for c in PRICED)},
        {ratio('sum(DISCOUNT_AMOUNT)', 'sum(GROSS_REVENUE)')} * 100.0 AS DISCOUNT_RATE
        FROM pricing_gold""",
    "report_pricing_summary": f"""SELECT DISCOUNT_STATUS, {dbl('sum(GROSS_REVENUE)', 'GROSS_REVENUE')},
        {dbl('sum(NET_REVENUE)', 'NET_REVENUE')}, CAST(sum(TOTAL_ORDERS) AS BIGINT) AS ORDERS,
        avg(AVG_ORDER_VALUE) AS AVG_ORDER_VALUE FROM pricing_gold GROUP BY 1""",
    "report_pricing_detail": f"SELECT {PRICING_OUT} FROM pricing_gold",
    # Pipeline
    "batch_end_to_end": f"""SELECT 'customer_lifetime_value' AS DATASET, count(*) AS ROW_COUNT FROM clv_gold
        UNION ALL SELECT 'customer_segmentation', count(*) FROM rfm_gold
        UNION ALL SELECT 'customer_churn_indicators', count(*) FROM churn_gold
        UNION ALL SELECT 'loyalty_program_impact', count(*) FROM loyalty_gold
        UNION ALL SELECT 'sales_trends', count(*) FROM sales_gold
        UNION ALL SELECT 'top_performing_locations', count(*) FROM locations_gold
        UNION ALL SELECT 'pricing_discount_effectiveness', count(*) FROM pricing_gold""",
}


# The same result by another way through the engine.
QUERIES |= {
    "sales_daily_streamed": QUERIES["sales_daily"],
    "csv_typed_items": QUERIES["csv_inferred_items"],
    "csv_typed_options": QUERIES["csv_inferred_options"],
    "csv_typed_dates": QUERIES["csv_inferred_dates"],
    "clv_segments_large": QUERIES["clv_segments"],
    "rfm_scores_large": QUERIES["rfm_scores"],
    "location_ranking_large": QUERIES["location_ranking"],
    "report_gap_box_large": QUERIES["report_gap_box"],
    "batch_customer_lifetime_value": QUERIES["clv_segments"],
    "batch_customer_segmentation": QUERIES["rfm_segments"],
    "batch_customer_churn_indicators": QUERIES["churn_indicators"],
    "batch_loyalty_program_impact": QUERIES["loyalty_impact"],
    "batch_sales_trends": QUERIES["sales_trends"],
    "batch_top_performing_locations": QUERIES["location_ranking"],
    "batch_pricing_discount_effectiveness": QUERIES["pricing_effectiveness"],
}


def oracle_texts() -> dict[str, str]:
    return {name: with_steps(select) for name, select in QUERIES.items()}
