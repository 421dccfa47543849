"""The headline metrics as straightforward SQL, to measure against.

One statement per summary, whole-table windows in a single partition, scalars fetched by the
driver, joins of separately computed parts: the plan shapes the library avoids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BUYERS = """(SELECT *, coalesce(USER_ID, PRINTED_CARD_NUMBER) AS CUSTOMER_ID,
    ITEM_PRICE * ITEM_QUANTITY AS REVENUE FROM order_items
    WHERE coalesce(USER_ID, PRINTED_CARD_NUMBER) IS NOT NULL)"""


def _today(spark: SparkSession) -> str:
    latest = spark.sql(f"SELECT max(CREATION_TIME_UTC) AS t FROM {BUYERS}").first()["t"]
    return f"TIMESTAMP '{latest}'"


def rfm_segments(spark: SparkSession) -> DataFrame:
    def step(metric: str, sign: str, limits: tuple[float, ...]) -> str:
        rank = f"percent_rank() OVER (ORDER BY {metric})"
        whens = " ".join(f"WHEN {rank} {sign} {q} THEN {5 - i}" for i, q in enumerate(limits))
        return f"CASE {whens} ELSE 1 END"

    up, down = (0.2, 0.4, 0.6, 0.8), (0.8, 0.6, 0.4, 0.2)
    return spark.sql(f"""
        WITH base AS (SELECT CUSTOMER_ID, max(CREATION_TIME_UTC) AS LAST_PURCHASE_DATE,
            count(DISTINCT ORDER_ID) AS FREQUENCY, sum(REVENUE) AS MONETARY,
            max(IS_LOYALTY) AS IS_LOYALTY FROM {BUYERS} GROUP BY CUSTOMER_ID),
        recent AS (SELECT *, datediff({_today(spark)}, LAST_PURCHASE_DATE) AS RECENCY FROM base),
        scored AS (SELECT *, {step('RECENCY', '<=', up)} AS R,
            {step('FREQUENCY', '>=', down)} AS F, {step('MONETARY', '>=', down)} AS M FROM recent)
        SELECT *, concat(R, F, M) AS RFM_SCORE, CASE WHEN R >= 4 AND F >= 4 AND M >= 4 THEN 'VIP'
            WHEN R >= 4 AND F <= 2 THEN 'New Customer' WHEN R <= 2 AND F <= 2 THEN 'Churn Risk'
            ELSE 'Regular Customer' END AS CUSTOMER_SEGMENT FROM scored""")


def clv_segments(spark: SparkSession) -> DataFrame:
    return spark.sql("""
        WITH extras AS (SELECT ORDER_ID, LINEITEM_ID, sum(OPTION_PRICE * OPTION_QUANTITY) AS extra
            FROM order_item_options GROUP BY ORDER_ID, LINEITEM_ID),
        totals AS (SELECT coalesce(USER_ID, PRINTED_CARD_NUMBER) AS CUSTOMER_ID,
            sum(ITEM_PRICE * ITEM_QUANTITY + coalesce(extra, 0)) AS CUSTOMER_LIFETIME_VALUE
            FROM order_items LEFT JOIN extras USING (ORDER_ID, LINEITEM_ID)
            WHERE coalesce(USER_ID, PRINTED_CARD_NUMBER) IS NOT NULL GROUP BY 1),
        ranked AS (SELECT *, percent_rank() OVER (ORDER BY CUSTOMER_LIFETIME_VALUE) AS PERCENT_RANK
            FROM totals)
        SELECT *, CASE WHEN PERCENT_RANK >= 0.8 THEN 'High CLV'
            WHEN PERCENT_RANK >= 0.2 THEN 'Medium CLV' ELSE 'Low CLV' END AS CLV_SEGMENT
        FROM ranked""")


def churn_indicators(spark: SparkSession) -> DataFrame:
    today = _today(spark)
    return spark.sql(f"""
        WITH latest AS (SELECT CUSTOMER_ID, max(CREATION_TIME_UTC) AS LAST_ORDER_DATE
            FROM {BUYERS} GROUP BY CUSTOMER_ID),
        gaps AS (SELECT CUSTOMER_ID, datediff(CREATION_TIME_UTC, lag(CREATION_TIME_UTC) OVER (
            PARTITION BY CUSTOMER_ID ORDER BY CREATION_TIME_UTC)) AS gap FROM {BUYERS}),
        mean_gap AS (SELECT CUSTOMER_ID, avg(gap) AS AVG_ORDER_GAP_DAYS FROM gaps
            GROUP BY CUSTOMER_ID),
        dated AS (SELECT CUSTOMER_ID, REVENUE, datediff({today}, CREATION_TIME_UTC) AS age
            FROM {BUYERS}),
        spend AS (SELECT CUSTOMER_ID,
            coalesce(sum(CASE WHEN age > 90 THEN REVENUE END), 0) AS PREVIOUS_SPEND,
            coalesce(sum(CASE WHEN age <= 90 THEN REVENUE END), 0) AS RECENT_SPEND
            FROM dated WHERE age <= 180 GROUP BY CUSTOMER_ID)
        SELECT *, datediff({today}, LAST_ORDER_DATE) AS DAYS_SINCE_LAST_ORDER,
            CASE WHEN PREVIOUS_SPEND > 0 THEN (RECENT_SPEND - PREVIOUS_SPEND) / PREVIOUS_SPEND * 100
            ELSE 0 END AS SPEND_CHANGE_PERCENT,
            CASE WHEN datediff({today}, LAST_ORDER_DATE) > 90 THEN 'High Risk'
            WHEN datediff({today}, LAST_ORDER_DATE) > 45 THEN 'At Risk' ELSE 'Active' END
            AS CHURN_STATUS
        FROM latest LEFT JOIN mean_gap USING (CUSTOMER_ID) LEFT JOIN spend USING (CUSTOMER_ID)""")


def sales_trends(spark: SparkSession) -> DataFrame:
    hour = "hour(CREATION_TIME_UTC)"
    lines = f"""(SELECT *, to_date(CREATION_TIME_UTC) AS SALES_DATE,
        year(CREATION_TIME_UTC) AS YEAR, weekofyear(CREATION_TIME_UTC) AS WEEK,
        month(CREATION_TIME_UTC) AS MONTH, CASE WHEN {hour} < 6 THEN 'Late Night'
        WHEN {hour} < 12 THEN 'Morning' WHEN {hour} < 17 THEN 'Afternoon'
        WHEN {hour} < 21 THEN 'Evening' ELSE 'Night' END AS TIME_OF_DAY FROM order_items)"""

    def summary(keys: str, period: str) -> DataFrame:
        return spark.sql(f"""SELECT {keys}, RESTAURANT_ID, ITEM_CATEGORY, TIME_OF_DAY,
            sum(ITEM_PRICE * ITEM_QUANTITY) AS TOTAL_REVENUE,
            count(DISTINCT ORDER_ID) AS TOTAL_ORDERS, sum(ITEM_QUANTITY) AS ITEMS_SOLD,
            '{period}' AS SALES_PERIOD FROM {lines}
            GROUP BY {keys}, RESTAURANT_ID, ITEM_CATEGORY, TIME_OF_DAY""")

    return (
        summary("SALES_DATE", "DAILY")
        .unionByName(summary("YEAR, WEEK", "WEEKLY"), allowMissingColumns=True)
        .unionByName(summary("YEAR, MONTH", "MONTHLY"), allowMissingColumns=True)
        .selectExpr("*", "TOTAL_REVENUE / TOTAL_ORDERS AS AVG_ORDER_VALUE")
    )


def pricing_effectiveness(spark: SparkSession) -> DataFrame:
    orders = """
        WITH gross AS (SELECT ORDER_ID, round(sum(ITEM_PRICE * ITEM_QUANTITY), 2) AS g
            FROM order_items GROUP BY ORDER_ID),
        cuts AS (SELECT ORDER_ID, round(sum(-OPTION_PRICE), 2) AS d FROM order_item_options
            WHERE OPTION_PRICE < 0 GROUP BY ORDER_ID),
        priced AS (SELECT ORDER_ID, g, coalesce(d, 0) AS d,
            CASE WHEN d > 0 THEN 'DISCOUNTED_ORDER' ELSE 'NON_DISCOUNTED_ORDER' END
            AS DISCOUNT_STATUS FROM gross LEFT JOIN cuts USING (ORDER_ID))
        SELECT DISCOUNT_STATUS, count(DISTINCT ORDER_ID) AS TOTAL_ORDERS,
            round(sum(g), 2) AS GROSS_REVENUE, round(sum(d), 2) AS DISCOUNT_AMOUNT,
            round(sum(g - d), 2) AS NET_REVENUE FROM priced GROUP BY DISCOUNT_STATUS"""
    per_status = spark.sql(orders)
    total = per_status.selectExpr("sum(NET_REVENUE) AS t").first()["t"]
    return per_status.selectExpr(
        "*",
        "round(NET_REVENUE / TOTAL_ORDERS, 2) AS AVG_ORDER_VALUE",
        f"round(NET_REVENUE / {total} * 100, 2) AS REVENUE_PERCENTAGE",
    )


def location_ranking(spark: SparkSession) -> DataFrame:
    return spark.sql("""
        WITH totals AS (SELECT RESTAURANT_ID, sum(ITEM_PRICE * ITEM_QUANTITY) AS TOTAL_REVENUE,
            count(DISTINCT ORDER_ID) AS TOTAL_ORDERS,
            count(DISTINCT CREATION_TIME_UTC) AS ACTIVE_DAYS,
            min(CREATION_TIME_UTC) AS FIRST_ORDER_DATE, max(CREATION_TIME_UTC) AS LAST_ORDER_DATE
            FROM order_items GROUP BY RESTAURANT_ID)
        SELECT *, TOTAL_ORDERS / ACTIVE_DAYS AS ORDERS_PER_DAY, ACTIVE_DAYS / 7 AS ACTIVE_WEEKS,
            TOTAL_ORDERS / (ACTIVE_DAYS / 7) AS ORDERS_PER_WEEK,
            TOTAL_REVENUE / TOTAL_ORDERS AS AVG_ORDER_VALUE,
            dense_rank() OVER (ORDER BY TOTAL_REVENUE DESC) AS REVENUE_RANK FROM totals""")


def loyalty_impact(spark: SparkSession) -> DataFrame:
    return spark.sql(f"""SELECT *, TOTAL_SPEND / TOTAL_ORDERS AS AVG_ORDER_VALUE FROM (
        SELECT CUSTOMER_ID, IS_LOYALTY, sum(REVENUE) AS TOTAL_SPEND,
        count(DISTINCT ORDER_ID) AS TOTAL_ORDERS FROM {BUYERS} GROUP BY CUSTOMER_ID, IS_LOYALTY)""")


def silver_order_items(spark: SparkSession) -> DataFrame:
    return spark.sql("""
        WITH once AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY LINEITEM_ID
            ORDER BY ITEM_QUANTITY) AS copy FROM raw_order_items) WHERE copy = 1)
        SELECT LINEITEM_ID, ORDER_ID, trim(APP_NAME) AS APP_NAME, trim(RESTAURANT_ID) AS RESTAURANT_ID,
            trim(CURRENCY) AS CURRENCY, trim(ITEM_CATEGORY) AS ITEM_CATEGORY,
            trim(ITEM_NAME) AS ITEM_NAME, try_cast(CREATION_TIME_UTC AS timestamp) AS CREATION_TIME_UTC,
            try_cast(ITEM_PRICE AS decimal(10,2)) AS ITEM_PRICE,
            try_cast(try_cast(ITEM_QUANTITY AS double) AS int) AS ITEM_QUANTITY,
            coalesce(try_cast(IS_LOYALTY AS double) = 1, false) AS IS_LOYALTY, USER_ID,
            trim(PRINTED_CARD_NUMBER) AS PRINTED_CARD_NUMBER,
            CASE WHEN coalesce(trim(USER_ID), '') = '' THEN 'MISSING_USER_ID'
                ELSE 'VALID_USER_ID' END AS USER_ID_STATUS,
            CASE WHEN coalesce(trim(PRINTED_CARD_NUMBER), '') = '' THEN 'MISSING_CARD_NUMBER'
                ELSE 'VALID_CARD_NUMBER' END AS CARD_NUMBER_STATUS
        FROM once WHERE try_cast(ITEM_QUANTITY AS double) >= 1""")


def silver_options(spark: SparkSession) -> DataFrame:
    return spark.sql("""
        SELECT ORDER_ID, LINEITEM_ID, trim(OPTION_GROUP_NAME) AS OPTION_GROUP_NAME,
            trim(OPTION_NAME) AS OPTION_NAME, try_cast(OPTION_PRICE AS decimal(10,2)) AS OPTION_PRICE,
            try_cast(try_cast(OPTION_QUANTITY AS double) AS int) AS OPTION_QUANTITY
        FROM raw_order_item_options GROUP BY 1, 2, 3, 4, 5, 6 HAVING count(*) = 1""")


def report_gap_box(spark: SparkSession) -> DataFrame:
    return spark.sql("""
        SELECT CHURN_STATUS, min(AVG_ORDER_GAP_DAYS) AS MINIMUM,
            percentile(AVG_ORDER_GAP_DAYS, array(0.25, 0.5, 0.75)) AS QUARTILES,
            max(AVG_ORDER_GAP_DAYS) AS MAXIMUM
        FROM customer_churn_indicators WHERE CHURN_STATUS IS NOT NULL GROUP BY CHURN_STATUS""")


def report_exec_kpis_fixed(spark: SparkSession) -> DataFrame:
    return spark.sql("""
        SELECT (SELECT count(DISTINCT CUSTOMER_ID) FROM customer_segmentation) AS TOTAL_CUSTOMERS,
            sum(ITEM_PRICE * ITEM_QUANTITY) AS TOTAL_REVENUE,
            count(DISTINCT ORDER_ID) AS TOTAL_ORDERS,
            (SELECT count(*) FROM customer_churn_indicators
             WHERE CHURN_STATUS IN ('At Risk', 'High Risk')) AS CUSTOMERS_AT_RISK
        FROM order_items""")


PLAIN = {
    f.__name__: f
    for f in (
        rfm_segments,
        clv_segments,
        churn_indicators,
        sales_trends,
        pricing_effectiveness,
        location_ranking,
        loyalty_impact,
        silver_order_items,
        silver_options,
        report_gap_box,
        report_exec_kpis_fixed,
    )
}
