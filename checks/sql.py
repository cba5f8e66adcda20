"""SQL for DuckDB that gives the expected result of each registered query.

Written from the definition of each figure, on the derived tables of FIXTURES.md.
"""

from __future__ import annotations

CUTOFF = "DATE '2001-08-16'"

# --- derived tables and views, with the views each builds on ------------------------

_SALE_KEYS = """l_orderkey * 8 + l_linenumber AS id, CAST(l_shipdate AS DATE) AS date,
    CAST(l_suppkey AS INT) AS store_nbr, CAST(l_partkey AS INT) AS item_nbr"""

_TABLES: dict[str, tuple[tuple[str, ...], str]] = {
    "train": (
        (),
        f"""SELECT {_SALE_KEYS},
    CAST(CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN -l_quantity
              WHEN l_linenumber = 2 THEN l_quantity / 8
              ELSE l_quantity END AS DECIMAL(12, 5)) AS unit_sales,
    CASE WHEN l_shipdate < TIMESTAMP '1996-04-01 00:00:00' THEN NULL
         ELSE l_discount >= 0.07 END AS onpromotion
FROM lineitem WHERE l_shipdate < TIMESTAMP '2001-08-16 00:00:00'""",
    ),
    "test": (
        (),
        f"""SELECT {_SALE_KEYS}, l_discount >= 0.07 AS onpromotion
FROM lineitem WHERE l_shipdate >= TIMESTAMP '2001-08-16 00:00:00'""",
    ),
    "stores": (
        (),
        """SELECT CAST(s_suppkey AS INT) AS store_nbr, n_name AS city, r_name AS state,
    substr('ABCDE', CAST(s_suppkey % 5 AS INT) + 1, 1) AS type,
    CAST(s_suppkey % 17 + 1 AS INT) AS cluster
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
WHERE s_suppkey % 10 <> 9""",
    ),
    "items": (
        (),
        """SELECT CAST(p_partkey AS INT) AS item_nbr, p_brand AS family, p_size AS class,
    CAST(CASE WHEN p_partkey % 4 = 0 THEN 1 ELSE 0 END AS SMALLINT) AS perishable
FROM part WHERE p_partkey % 100 <> 99""",
    ),
    "transactions": (
        (),
        """SELECT CAST(l_shipdate AS DATE) AS date, CAST(l_suppkey AS INT) AS store_nbr,
    CAST(COUNT(DISTINCT l_orderkey) AS INT) AS transactions
FROM lineitem WHERE l_shipdate < TIMESTAMP '2001-08-16 00:00:00'
GROUP BY CAST(l_shipdate AS DATE), CAST(l_suppkey AS INT)""",
    ),
    "oil": (
        (),
        """SELECT CAST(o_orderdate AS DATE) AS date,
    CASE WHEN extract(day FROM CAST(o_orderdate AS DATE)) % 13 = 0
              OR CAST(o_orderdate AS DATE) <= DATE '1995-01-06' THEN NULL
         ELSE CAST(FLOOR(MIN(o_totalprice) / 10) / 100 AS DECIMAL(10, 2)) END AS dcoilwtico
FROM orders WHERE dayname(CAST(o_orderdate AS DATE)) NOT LIKE 'S%'
GROUP BY CAST(o_orderdate AS DATE)""",
    ),
    "holidays_events": (
        (),
        """SELECT CAST(o_orderdate AS DATE) AS date,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'Holiday' WHEN '2-HIGH' THEN 'Event'
         WHEN '3-MEDIUM' THEN 'Additional' WHEN '5-LOW' THEN 'Work Day'
         ELSE 'Transfer' END AS type,
    CASE WHEN c_mktsegment = 'BUILDING' THEN 'National'
         WHEN c_mktsegment = 'AUTOMOBILE' THEN 'Regional' ELSE 'Local' END AS locale,
    CASE WHEN c_mktsegment = 'BUILDING' THEN 'Country'
         WHEN c_mktsegment = 'AUTOMOBILE' THEN r_name ELSE n_name END AS locale_name,
    concat('Event ', CAST(o_orderkey % 7 AS STRING)) AS description,
    CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderstatus = 'P' END AS transferred
FROM orders JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
WHERE extract(day FROM CAST(o_orderdate AS DATE)) <= 8""",
    ),
    "oil_calendar": (
        ("oil",),
        """SELECT CAST(day AS DATE) AS date, dcoilwtico AS oil_price_raw
FROM (SELECT unnest(generate_series((SELECT min(date) FROM oil), (SELECT max(date) FROM oil),
                                    INTERVAL 1 DAY)) AS day) AS days
    LEFT JOIN oil ON CAST(day AS DATE) = oil.date""",
    ),
    "oil_groups": (
        ("oil_calendar",),
        "SELECT *, count(oil_price_raw) OVER (ORDER BY date) AS fill_group FROM oil_calendar",
    ),
    "oil_clean": (
        ("oil_groups",),
        """SELECT date,
    coalesce(max(oil_price_raw) OVER (PARTITION BY fill_group),
             (SELECT dcoilwtico FROM oil WHERE dcoilwtico IS NOT NULL ORDER BY date LIMIT 1)
    ) AS oil_price,
    oil_price_raw IS NULL AS is_imputed
FROM oil_groups""",
    ),
    "sales": (
        ("train", "test"),
        """SELECT id, date, store_nbr, item_nbr, unit_sales, onpromotion FROM train
WHERE unit_sales > 0
UNION ALL
SELECT id, date, store_nbr, item_nbr, NULL, onpromotion FROM test""",
    ),
    "train_clean": (
        ("sales", "stores", "items"),
        """SELECT *, is_orphan_store OR is_orphan_item AS has_integrity_issues
FROM (SELECT *, store_nbr NOT IN (SELECT store_nbr FROM stores) AS is_orphan_store,
             item_nbr NOT IN (SELECT item_nbr FROM items) AS is_orphan_item
      FROM sales) AS flagged""",
    ),
    "holidays_clean": (
        ("holidays_events",),
        """SELECT date, string_agg(DISTINCT type, ',' ORDER BY type) AS type, locale, locale_name,
    string_agg(DISTINCT description, ',' ORDER BY description) AS description,
    count(*) AS holiday_count, count(*) > 1 AS is_multiple_holidays
FROM holidays_events WHERE transferred = FALSE GROUP BY date, locale, locale_name""",
    ),
    "placed": (
        ("sales", "stores"),
        """SELECT sales.*, city, state, type AS store_type, cluster AS store_cluster
FROM sales LEFT JOIN stores USING (store_nbr)""",
    ),
    "matched": (
        ("placed", "holidays_clean"),
        """SELECT placed.*, holidays_clean.date IS NOT NULL AS is_holiday,
    holidays_clean.type AS holiday_type, description AS holiday_description
FROM placed LEFT JOIN holidays_clean ON placed.date = holidays_clean.date
    AND (locale = 'National' OR (locale = 'Regional' AND locale_name = state)
         OR (locale = 'Local' AND locale_name = city))""",
    ),
    "master": (
        ("matched", "items", "oil_clean"),
        """SELECT id, matched.date, store_nbr, matched.item_nbr, unit_sales, onpromotion,
    city, state, store_type, store_cluster, family AS item_family, class AS item_class, perishable,
    oil_price, is_imputed AS oil_is_imputed, is_holiday, holiday_type, holiday_description,
    CAST(extract(year FROM matched.date) AS INT) AS year,
    CAST(extract(month FROM matched.date) AS INT) AS month,
    CAST(extract(week FROM matched.date) AS INT) AS week_of_year,
    CAST(extract(day FROM matched.date) AS INT) AS day_of_month,
    CAST(extract(dow FROM matched.date) AS INT) AS day_of_week,
    extract(dow FROM matched.date) IN (0, 6) AS is_weekend,
    extract(day FROM matched.date) = 15 OR matched.date = last_day(matched.date) AS is_payday,
    extract(day FROM matched.date) <= 7 AS is_month_start,
    extract(day FROM matched.date) >= 24 AS is_month_end
FROM matched LEFT JOIN items ON matched.item_nbr = items.item_nbr
    LEFT JOIN oil_clean ON matched.date = oil_clean.date""",
    ),
    "past": (("master",), f"SELECT * FROM master WHERE date < {CUTOFF}"),
    "known": (("master",), "SELECT * FROM master WHERE unit_sales IS NOT NULL"),
}


def _mean(column: str, digits: int = 2) -> str:
    """Mean of a column with five decimals, halves away from zero, in whole numbers."""
    units = f"CAST(sum({column}) * 100000 AS HUGEINT)"
    step = 10 ** (5 - digits)
    rounded = f"(2 * abs({units}) + count({column}) * {step}) // (2 * count({column}) * {step})"
    return f"CAST(sign(sum({column})) * ({rounded}) AS DOUBLE) / {10 ** digits}"


_TABLES["daily"] = (
    ("train",),
    f"""SELECT date, count(*) AS num_transactions,
    CAST(round(sum(unit_sales), 0) AS DOUBLE) AS total_sales, {_mean("unit_sales")} AS avg_sales,
    count(DISTINCT store_nbr) AS active_stores, count(DISTINCT item_nbr) AS unique_items
FROM train GROUP BY date""",
)
_TABLES["averaged"] = (
    ("daily",),
    """SELECT date, total_sales, CASE WHEN count(total_sales) OVER last_30 = 30
    THEN avg(total_sales) OVER last_30 END AS ma_30
FROM daily WINDOW last_30 AS (ORDER BY date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)""",
)
_TABLES["months"] = (
    ("daily",),
    """SELECT CAST(extract(month FROM date) AS INT) AS month,
    strftime(min(date), '%b') AS month_name,
    round_even(sum(total_sales) / count(*), 0) AS total_sales,
    round_even(CAST(sum(num_transactions) AS DOUBLE) / count(*), 0) AS num_transactions
FROM daily GROUP BY extract(month FROM date)""",
)
_TABLES["weekdays"] = (
    ("daily",),
    """SELECT CAST(extract(isodow FROM date) - 1 AS INT) AS day_order, dayname(date) AS day_name,
    sum(total_sales) / count(*) AS total_sales,
    CAST(sum(num_transactions) AS DOUBLE) / count(*) AS num_transactions
FROM daily GROUP BY ALL""",
)
_TABLES["day_kinds"] = (
    ("daily", "holidays_events"),
    """SELECT type IS NOT NULL AS is_holiday,
    CASE WHEN type IS NOT NULL THEN 'Holidays' ELSE 'Regular Days' END AS day_kind,
    round_even(sum(total_sales) / count(*), 0) AS total_sales
FROM daily LEFT JOIN holidays_events ON daily.date = holidays_events.date GROUP BY ALL""",
)
_TABLES["performance"] = (
    ("train", "stores"),
    """SELECT stores.store_nbr, city, state, type, cluster, count(*) AS number_transactions,
    CAST(sum(unit_sales) AS DOUBLE) AS total_sales,
    count(DISTINCT item_nbr) AS unique_items_sold, count(DISTINCT date) AS days_active
FROM train JOIN stores ON train.store_nbr = stores.store_nbr GROUP BY ALL""",
)
_TABLES["families"] = (
    ("train", "items"),
    f"""SELECT family, count(*) AS num_transactions,
    CAST(round(sum(unit_sales), 0) AS DOUBLE) AS total_sales, {_mean("unit_sales")} AS avg_sales,
    count(DISTINCT train.item_nbr) AS unique_items, count(DISTINCT store_nbr) AS stores_selling
FROM train JOIN items ON train.item_nbr = items.item_nbr GROUP BY family""",
)
_TABLES["promotions"] = (
    ("train",),
    f"""SELECT coalesce(onpromotion, FALSE) AS on_promotion,
    CASE WHEN coalesce(onpromotion, FALSE) THEN 'With Promotion' ELSE 'No Promotion' END
        AS promotion,
    CAST(round(sum(unit_sales), 0) AS DOUBLE) AS total_sales,
    {_mean("unit_sales")} AS avg_sales_per_transaction, count(*) AS num_transactions
FROM train GROUP BY ALL""",
)
_TABLES["latest"] = (
    ("train",),
    """SELECT * FROM train
ORDER BY date DESC, id DESC, store_nbr DESC, item_nbr DESC, unit_sales DESC,
    onpromotion DESC NULLS LAST
LIMIT 100000""",
)
_TABLES["latest_10k"] = (
    ("train",),
    _TABLES["latest"][1].replace("LIMIT 100000", "LIMIT 10000"),
)


def _needed(names: tuple[str, ...], found: dict[str, str]) -> dict[str, str]:
    for name in names:
        if name not in found:
            builds_on, text = _TABLES[name]
            _needed(builds_on, found)
            found[name] = text
    return found


def _query(names: str, body: str) -> str:
    """``body`` with the definitions of the views in ``names`` in front."""
    views = _needed(tuple(names.split()), {})
    heads = ",\n".join(f"{name} AS (\n{text}\n)" for name, text in views.items())
    joint = "" if body.startswith(",") else "\n"
    return f"WITH {heads}{joint}{body}"


def _total(column: str = "unit_sales") -> str:
    return f"CAST(sum({column}) AS DOUBLE)"


def _flag(column: str) -> str:
    return f"CAST(sum(CASE WHEN {column} THEN 1 ELSE 0 END) AS BIGINT)"


def _counts_of(table: str, column: str, top: str = "") -> str:
    return _query(
        table,
        f"""SELECT {column}, count(*) AS count FROM {table} WHERE {column} IS NOT NULL
GROUP BY {column} ORDER BY count DESC, {column} {top}""",
    )


def _per_column(tables: dict[str, str], value: str, name: str) -> str:
    """One row per table and column; ``value`` holds {column}."""
    rows = [
        f"SELECT '{table}' AS table_name, '{column}' AS column_name, "
        f"{value.format(column=column)} AS {name} FROM {table}"
        for table, columns in tables.items()
        for column in columns.split()
    ]
    return _query(" ".join(tables), "\nUNION ALL ".join(rows))


def _describe(table: str, columns: str) -> str:
    rows = [
        f"""SELECT '{c}' AS column_name, count({c}) AS count,
    round({_total(c)} / count({c}), 6) AS mean,
    round(stddev_samp(CAST({c} AS DOUBLE)), 6) AS std, CAST(min({c}) AS DOUBLE) AS min,
    round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 6) AS p25,
    round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) AS p50,
    round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 6) AS p75,
    CAST(max({c}) AS DOUBLE) AS max FROM {table}"""
        for c in columns.split()
    ]
    return _query(table, "\nUNION ALL ".join(rows))


def _top(table: str, dimension: str) -> str:
    return _query(
        table,
        f"""SELECT {dimension}, {_total()} AS total_sales FROM {table} GROUP BY {dimension}
ORDER BY sum(unit_sales) DESC, {dimension} NULLS FIRST LIMIT 10""",
    )


def _series(condition: str) -> str:
    return _query(
        "known",
        f"SELECT date, {_total()} AS total_sales FROM known WHERE {condition} GROUP BY date",
    )


def _promo(condition: str) -> str:
    return _query(
        "known",
        f"""SELECT onpromotion, {_total()} AS total_sales,
    CASE onpromotion WHEN TRUE THEN 'With Promotion' WHEN FALSE THEN 'Without Promotion' END
        AS promotion_status
FROM known WHERE {condition} GROUP BY onpromotion""",
    )


def _share(ranked: str, key: str) -> str:
    def top(n: int) -> str:
        return f"""(SELECT sum(total_sales) FROM (SELECT total_sales FROM {ranked}
    ORDER BY total_sales DESC, {key} LIMIT {n}) AS best) / sum(total_sales) * 100"""

    return (
        f"sum(total_sales) AS total_sales, {top(5)} AS top5_sales_pct, "
        f"{top(10)} AS top10_sales_pct"
    )


def _change(table: str, flag: str, value: str, name: str) -> str:
    return _query(
        table,
        f"""SELECT (max(CASE WHEN {flag} THEN {value} END)
    / max(CASE WHEN NOT {flag} THEN {value} END) - 1) * 100 AS {name} FROM {table}""",
    )


_LOADED = "stores items transactions oil holidays_events train"
_CHOSEN = "store_nbr = 6 AND item_family = 'Brand#19' AND year = 1999"

_SQL: dict[str, str] = {
    "s_table_counts": _query(
        _LOADED,
        "\nUNION ALL ".join(
            f"SELECT '{name}' AS table_name, count(*) AS row_count, "
            f"CAST(NULL AS VARCHAR) AS error FROM {name}"
            for name in _LOADED.split()
        ),
    ),
    "csv_dimensions": _query(
        "stores items transactions oil holidays_events",
        "\nUNION ALL ".join(
            f"SELECT '{table}' AS table_name, count(*) AS rows, "
            f"CAST(sum(length(concat_ws('|', {columns}))) AS BIGINT) AS characters FROM {table}"
            for table, columns in {
                "stores": "store_nbr, city, state, type, cluster",
                "items": "item_nbr, family, class, perishable",
                "transactions": "date, store_nbr, transactions",
                "oil": "date, dcoilwtico",
                "holidays_events": "date, type, locale, locale_name, description, FALSE",
            }.items()
        ),
    ),
    "predictions_roundtrip": _query(
        "test",
        """SELECT count(*) AS rows, CAST(sum(id) AS BIGINT) AS ids,
    CAST(sum(id % 7) AS DOUBLE) AS units FROM test""",
    ),
    "append_rows": _query(
        "oil",
        """SELECT 2 * count(*) AS rows, CAST(2 * sum(dcoilwtico) AS DOUBLE) AS total_price
FROM oil""",
    ),
    "clean_view_counts": _query(
        "oil_clean train_clean holidays_clean master",
        "\nUNION ALL ".join(
            f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {name}"
            for name in ("oil_clean", "train_clean", "holidays_clean", "master")
        ),
    ),
    "export_years": _query(
        "master",
        """SELECT year, count(*) AS rows FROM master WHERE year IN (1996, 1998, 2001)
GROUP BY ROLLUP (year)""",
    ),
    "layout_check": "SELECT CAST(0 AS BIGINT) AS violations",
    "csv_roundtrip": _query(
        "train",
        f"""SELECT count(*) AS data_lines, count(*) AS rows_loaded, {_total()} AS total_sales,
    {_flag("onpromotion IS NULL")} AS unknown_promotions, {_flag("onpromotion")} AS promotions,
    min(date) AS first_date, max(date) AS last_date FROM train""",
    ),
    "incremental_load": _query(
        "train",
        f"""SELECT CAST(extract(year FROM date) AS INT) AS year, count(*) AS rows,
    {_total()} AS total_sales FROM train GROUP BY ALL""",
    ),
    "stream_unique_rows": _query(
        "train",
        """SELECT CAST(extract(year FROM date) AS INT) AS year, count(*) AS rows,
    CAST(sum(id) AS BIGINT) AS ids, min(date) AS first_date, max(date) AS last_date
FROM (SELECT DISTINCT id, date FROM train) AS keys GROUP BY ALL""",
    ),
    "rejected_rows": _query(
        "train stores items",
        """, damaged AS (
    SELECT id % 1000 IN (0, 3) AS malformed, CASE WHEN id % 1000 IN (1, 5) THEN NULL
            WHEN id % 1000 = 4 THEN DATE '1890-01-01' ELSE date END AS date,
        CASE WHEN id % 1000 <> 5 THEN store_nbr END AS store_nbr,
        CASE WHEN id % 1000 NOT IN (2, 5) THEN item_nbr END AS item_nbr,
        CASE WHEN id % 1000 <> 5 THEN unit_sales END AS unit_sales
    FROM train
), listed AS (
    SELECT row_number() OVER () AS n, unnest(CASE WHEN malformed THEN ['malformed line'] ELSE list_filter([
        CASE WHEN date IS NULL THEN 'date is missing' END,
        CASE WHEN store_nbr IS NULL THEN 'store_nbr is missing' END,
        CASE WHEN item_nbr IS NULL THEN 'item_nbr is missing' END,
        CASE WHEN unit_sales IS NULL THEN 'unit_sales is missing' END,
        CASE WHEN date < DATE '1995-01-01' OR date >= DATE '2002-01-01' THEN 'date is out of range' END,
        CASE WHEN store_nbr NOT IN (SELECT store_nbr FROM stores) THEN 'store_nbr is unknown' END,
        CASE WHEN item_nbr NOT IN (SELECT item_nbr FROM items) THEN 'item_nbr is unknown' END
    ], lambda x: x IS NOT NULL) END) AS reason FROM damaged
)
SELECT reason, count(*) AS rows FROM listed GROUP BY reason
UNION ALL SELECT 'refused', count(DISTINCT n) FROM listed
UNION ALL SELECT 'accepted', (SELECT count(*) FROM damaged) - count(DISTINCT n) FROM listed""",
    ),
    "observed_load": _query(
        "train",
        f"""SELECT count(*) AS rows, {_total()} AS total_sales,
    {_flag("onpromotion IS NULL")} AS unknown_promotions, {_flag("onpromotion")} AS promotions,
    min(date) AS first_date, max(date) AS last_date, count(*) AS stored_rows FROM train""",
    ),
    "whole_run": _query("master", "SELECT year, count(*) AS rows FROM master GROUP BY year"),
    "refreshed_views": _query(
        "train_clean master daily",
        """SELECT 'train_clean' AS view, CAST(extract(year FROM date) AS INT) AS year, count(*) AS rows,
    CAST(sum(unit_sales) AS DOUBLE) AS total_sales FROM train_clean GROUP BY ALL
UNION ALL SELECT 'master', year, count(*), CAST(sum(unit_sales) AS DOUBLE) FROM master GROUP BY ALL
UNION ALL SELECT 'daily', CAST(extract(year FROM date) AS INT), count(*), CAST(sum(total_sales) AS DOUBLE)
FROM daily GROUP BY ALL
UNION ALL SELECT 'summary', year, count(*), CAST(sum(units) AS DOUBLE)
FROM (SELECT year, date, store_nbr, item_family, onpromotion, sum(unit_sales) AS units FROM master
      GROUP BY ALL) AS cells GROUP BY year""",
    ),
    "surrogate_key": _query(
        "train", "SELECT count(*) AS rows, count(*) AS distinct_ids FROM train"
    ),
    "export_rows_per_year": _query(
        "master", "SELECT year, count(*) AS rows FROM master GROUP BY year"
    ),
    "oil_calendar": _query(
        "oil_calendar",
        "SELECT date, CAST(oil_price_raw AS DOUBLE) AS oil_price_raw FROM oil_calendar",
    ),
    "oil_clean": _query(
        "oil_clean",
        "SELECT date, CAST(oil_price AS DOUBLE) AS oil_price, is_imputed FROM oil_clean",
    ),
    "train_clean": _query(
        "train_clean",
        "SELECT * REPLACE (CAST(unit_sales AS DOUBLE) AS unit_sales) FROM train_clean",
    ),
    "holidays_clean": _query("holidays_clean", "SELECT * FROM holidays_clean"),
    "calendar_features": _query(
        "train",
        """SELECT date, CAST(extract(year FROM date) AS INT) AS year,
    CAST(extract(month FROM date) AS INT) AS month,
    CAST(extract(week FROM date) AS INT) AS week_of_year,
    CAST(extract(day FROM date) AS INT) AS day_of_month,
    CAST(extract(dow FROM date) AS INT) AS day_of_week,
    extract(dow FROM date) IN (0, 6) AS is_weekend,
    extract(day FROM date) = 15 OR date = last_day(date) AS is_payday,
    extract(day FROM date) <= 7 AS is_month_start, extract(day FROM date) >= 24 AS is_month_end
FROM (SELECT DISTINCT date FROM train) AS days""",
    ),
    "master": _query(
        "master",
        """SELECT * REPLACE (CAST(unit_sales AS DOUBLE) AS unit_sales,
    CAST(oil_price AS DOUBLE) AS oil_price) FROM master""",
    ),
    "master_holiday_join": _query(
        "matched",
        "SELECT id, date, store_nbr, is_holiday, holiday_type, holiday_description FROM matched",
    ),
    "v_oil": _query(
        "oil_clean",
        f"""SELECT count(*) AS total_rows, {_flag("is_imputed")} AS imputed_rows,
    min(date) AS min_date, max(date) AS max_date, CAST(min(oil_price) AS DOUBLE) AS min_price,
    CAST(max(oil_price) AS DOUBLE) AS max_price,
    CAST({_flag("is_imputed")} AS DOUBLE) / count(*) * 100 AS imputed_pct FROM oil_clean""",
    ),
    "v_train": _query(
        "train_clean",
        f"""SELECT count(*) AS total_rows, count(DISTINCT date) AS unique_dates,
    count(DISTINCT store_nbr) AS unique_stores, count(DISTINCT item_nbr) AS unique_items,
    min(date) AS min_date, max(date) AS max_date,
    {_flag("has_integrity_issues")} AS integrity_issues,
    {_flag("is_orphan_store")} AS orphan_stores, {_flag("is_orphan_item")} AS orphan_items
FROM train_clean WHERE date < {CUTOFF}""",
    ),
    "v_holidays": _query(
        "holidays_clean",
        f"""SELECT count(*) AS total_rows, count(DISTINCT date) AS unique_dates,
    count(DISTINCT locale) AS unique_locales, count(DISTINCT locale_name) AS unique_locale_names,
    min(date) AS min_date, max(date) AS max_date,
    {_flag("is_multiple_holidays")} AS multi_holidays_dates FROM holidays_clean""",
    ),
    "v_master": _query(
        "past",
        f"""SELECT count(*) AS total_rows, count(DISTINCT date) AS unique_dates,
    count(DISTINCT store_nbr) AS unique_stores, count(DISTINCT item_nbr) AS unique_items,
    min(date) AS min_date, max(date) AS max_date, {_mean("unit_sales")} AS avg_sales,
    {_mean("oil_price")} AS avg_oil_price, {_flag("onpromotion")} AS promotion_count,
    {_flag("is_holiday")} AS holiday_count, {_flag("is_weekend")} AS weekend_count,
    {_flag("is_payday")} AS payday_count, count(DISTINCT item_family) AS unique_families,
    count(DISTINCT store_type) AS unique_store_types FROM past""",
    ),
    "holiday_distribution": _query(
        "past",
        f"""SELECT holiday_type, count(*) AS occurrences, count(DISTINCT date) AS unique_dates,
    {_mean("unit_sales")} AS avg_sales_on_holiday
FROM past WHERE is_holiday GROUP BY holiday_type""",
    ),
    "payday_impact": _query(
        "past",
        f"""SELECT is_payday, count(*) AS transactions, {_mean("unit_sales")} AS avg_sales,
    round(stddev_samp(CAST(unit_sales AS DOUBLE)), 2) AS std_sales FROM past GROUP BY is_payday""",
    ),
    "top_families": _query(
        "past",
        """SELECT item_family, count(*) AS transactions,
    CAST(round(sum(unit_sales), 2) AS DOUBLE) AS total_sales FROM past GROUP BY item_family
ORDER BY total_sales DESC NULLS FIRST, item_family NULLS FIRST LIMIT 5""",
    ),
    "kpi": _query(
        "known stores items",
        f"""SELECT coalesce({_total()}, 0) AS total_sales,
    coalesce({_total()} / nullif(count(DISTINCT date), 0), 0) AS avg_daily_sales,
    count(DISTINCT date) AS total_days, (SELECT count(*) FROM stores) AS total_stores,
    (SELECT count(*) FROM items) AS total_items FROM known""",
    ),
    "monthly_sales": _query(
        "known",
        f"""SELECT year, month, {_total()} AS total_sales,
    concat(year, '-', lpad(CAST(month AS VARCHAR), 2, '0')) AS year_month
FROM known GROUP BY year, month""",
    ),
    "top_city": _top("known", "city"),
    "top_item_class": _top("known", "item_class"),
    "summary_sizes": _query(
        "master",
        "\nUNION ALL ".join(
            f"""SELECT '{keys}' AS keys, count(*) AS cells, CAST(sum(n) AS BIGINT) AS rows,
    CAST(sum(k) AS BIGINT) AS known, CAST(sum(s) AS DOUBLE) AS total_sales
FROM (SELECT count(*) AS n, count(unit_sales) AS k, sum(unit_sales) AS s FROM master
      GROUP BY {keys}) AS cells"""
            for keys in (
                "date,store_nbr,item_family,onpromotion",
                "date,item_family,onpromotion",
                "date,store_nbr",
                "date,onpromotion",
                "store_nbr,item_family,onpromotion",
            )
        ),
    ),
    "top_item_family": _top("known", "item_family"),
    "dow_average": _query(
        "known",
        f"""SELECT day_of_week, {_total("daily_total")} / count(*) AS avg_sales,
    dayname(min(date)) AS day_name
FROM (SELECT date, day_of_week, sum(unit_sales) AS daily_total FROM known GROUP BY ALL) AS days
GROUP BY day_of_week""",
    ),
    "filtered_series": _series(_CHOSEN),
    "filtered_series_year": _series("year = 1999"),
    "filtered_promo": _promo(_CHOSEN),
    "filtered_promo_year": _promo("year = 1999"),
    "filtered_promo_all": _promo("TRUE"),
    "filter_stores": _query("master", "SELECT DISTINCT store_nbr FROM master"),
    "filter_years": _query("master", "SELECT DISTINCT year FROM master"),
    "dimension_labels": _query(
        "known",
        """SELECT 'Item Family' AS label, item_family AS value, CAST(sum(unit_sales) AS DOUBLE)
    AS total_sales FROM known GROUP BY item_family
ORDER BY sum(unit_sales) DESC, item_family NULLS FIRST LIMIT 10""",
    ),
    "day_names": _query(
        "train",
        """SELECT date, CAST(extract(year FROM date) AS INT) AS year,
    CAST(extract(month FROM date) AS INT) AS month,
    CAST(extract(isodow FROM date) - 1 AS INT) AS day_of_week, dayname(date) AS day_name,
    CAST(extract(week FROM date) AS INT) AS week_of_year
FROM (SELECT DISTINCT date FROM train) AS days""",
    ),
    "filter_families": _query(
        "master", "SELECT DISTINCT item_family FROM master WHERE item_family IS NOT NULL"
    ),
    "vc_store_state": _counts_of("stores", "state"),
    "vc_store_city": _counts_of("stores", "city"),
    "vc_item_family": _counts_of("items", "family", "LIMIT 10"),
    "vc_perishable": _counts_of("items", "perishable"),
    "vc_holiday_type": _counts_of("holidays_events", "type"),
    "vc_holiday_locale": _counts_of("holidays_events", "locale"),
    "vc_holiday_year": _query(
        "holidays_events",
        """SELECT CAST(extract(year FROM date) AS INT) AS year, count(*) AS count
FROM holidays_events GROUP BY ALL""",
    ),
    "stores_type_cluster": _query(
        "stores", "SELECT type, cluster, count(*) AS count FROM stores GROUP BY type, cluster"
    ),
    "distinct_counts": _per_column(
        {
            "stores": "city state type cluster",
            "items": "family class",
            "holidays_events": "type",
            "transactions": "store_nbr",
        },
        "count(DISTINCT {column})",
        "distinct_values",
    ),
    "missing_values": _per_column(
        {
            "stores": "store_nbr city state type cluster",
            "items": "item_nbr family class perishable",
            "oil": "date dcoilwtico",
            "holidays_events": "date type locale locale_name description transferred",
            "transactions": "date store_nbr transactions",
        },
        "count(*) - count({column})",
        "missing",
    ),
    "tx_per_year": _query(
        "transactions",
        """SELECT CAST(extract(year FROM date) AS INT) AS year,
    CAST(sum(transactions) AS BIGINT) AS total_transactions FROM transactions GROUP BY ALL""",
    ),
    "date_span": _query(
        "train",
        """SELECT min(date) AS start_date, max(date) AS end_date,
    CAST(max(date) - min(date) AS INT) AS date_span FROM train""",
    ),
    "invalid_values": _query(
        "train",
        f"""SELECT {_flag("unit_sales IS NULL")} AS null_values,
    {_flag("unit_sales < 1")} AS refunds,
    {_flag("store_nbr IS NULL")} AS null_stores, {_flag("item_nbr IS NULL")} AS null_items
FROM train""",
    ),
    "latest_rows": _query(
        "latest", "SELECT * REPLACE (CAST(unit_sales AS DOUBLE) AS unit_sales) FROM latest"
    ),
    "latest_rows_10k": _query(
        "latest_10k",
        "SELECT * REPLACE (CAST(unit_sales AS DOUBLE) AS unit_sales) FROM latest_10k",
    ),
    "approx_items_by_span": _query(
        "train",
        """SELECT CAST(extract(year FROM date) AS INT) AS year, count(*) AS rows,
    count(DISTINCT store_nbr) AS stores, count(DISTINCT item_nbr) AS items,
    TRUE AS stores_close, TRUE AS items_close FROM train GROUP BY ALL""",
    ),
    "clustered_series": _query(
        "train",
        f"""SELECT date, count(*) AS rows, {_total()} AS total_sales FROM train
WHERE store_nbr = 6 OR item_nbr = 20 GROUP BY date""",
    ),
    "describe_sales": _describe("train", "unit_sales"),
    "fill_per_series": _query(
        "known",
        """, per_day AS (
    SELECT item_family, date, sum(unit_sales) AS units FROM known GROUP BY item_family, date
), days AS (
    SELECT item_family, CAST(unnest(generate_series(first, last, INTERVAL 1 DAY)) AS DATE) AS date
    FROM (SELECT item_family, min(date) AS first, max(date) AS last FROM per_day GROUP BY item_family)
), grouped AS (
    SELECT days.*, units, count(units) OVER (PARTITION BY days.item_family ORDER BY days.date) AS g
    FROM days LEFT JOIN per_day ON days.date = per_day.date
        AND days.item_family IS NOT DISTINCT FROM per_day.item_family
), filled AS (
    SELECT *, max(units) OVER (PARTITION BY item_family, g) AS filled FROM grouped
)
SELECT item_family, date, CAST(units AS DOUBLE) AS units, CAST(filled AS DOUBLE) AS filled,
    CASE WHEN count(*) OVER last_7 = 7 THEN CAST(sum(filled) OVER last_7 AS DOUBLE) / 7 END AS ma_7
FROM filled
WINDOW last_7 AS (PARTITION BY item_family ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
    ),
    "describe_latest": _describe("latest", "unit_sales"),
    "daily_sales": _query("daily", "SELECT * FROM daily"),
    "describe_daily": _describe("daily", "total_sales num_transactions avg_sales"),
    "year_ranges": _query(
        "daily",
        """SELECT CAST(extract(year FROM date) AS INT) AS year, min(date) AS first_date,
    max(date) AS last_date, count(*) AS days FROM daily GROUP BY extract(year FROM date)""",
    ),
    "yearly_sales": _query(
        "daily",
        """SELECT CAST(extract(year FROM date) AS INT) AS year, sum(total_sales) AS total_sales,
    CAST(sum(num_transactions) AS BIGINT) AS total_transactions, count(*) AS days,
    round_even(sum(total_sales) / count(*), 0) AS avg_daily_sales
FROM daily GROUP BY extract(year FROM date)""",
    ),
    "month_pattern": _query("months", "SELECT * FROM months"),
    "best_worst_month": _query(
        "months",
        """SELECT
    (SELECT month_name FROM months ORDER BY total_sales DESC, month LIMIT 1) AS best_month,
    (SELECT month_name FROM months ORDER BY total_sales, month LIMIT 1) AS worst_month""",
    ),
    "dow_vs_avg": _query(
        "weekdays",
        """SELECT *,
    round_even((total_sales / (SELECT avg(total_sales) FROM weekdays) - 1) * 100, 1)
    AS pct_vs_average FROM weekdays""",
    ),
    "holiday_vs_regular": _query("day_kinds", "SELECT * FROM day_kinds"),
    "holiday_lift": _change("day_kinds", "is_holiday", "total_sales", "holiday_lift_pct"),
    "december_stats": _query(
        "daily",
        """SELECT CAST(extract(year FROM date) AS INT) AS year,
    sum(total_sales) / count(*) AS mean, max(total_sales) AS max, min(total_sales) AS min
FROM daily WHERE extract(month FROM date) = 12 GROUP BY extract(year FROM date)""",
    ),
    "december_daily": _query(
        "daily",
        """SELECT CAST(extract(year FROM date) AS INT) AS year,
    CAST(extract(day FROM date) AS INT) AS day, total_sales
FROM daily WHERE extract(month FROM date) = 12""",
    ),
    "december_years": _query(
        "daily",
        """SELECT DISTINCT CAST(extract(year FROM date) AS INT) AS year
FROM daily WHERE extract(month FROM date) = 12""",
    ),
    "moving_avg_30": _query("averaged", "SELECT * FROM averaged"),
    "sales_vs_oil": _query(
        "averaged oil",
        """SELECT coalesce(averaged.date, oil.date) AS date, ma_30,
    CAST(dcoilwtico AS DOUBLE) AS dcoilwtico
FROM averaged FULL JOIN oil ON averaged.date = oil.date""",
    ),
    "store_perf": _query("performance", "SELECT * FROM performance"),
    "store_top_bottom": _query(
        "performance",
        """(SELECT 'top' AS position, store_nbr, total_sales FROM performance
    ORDER BY total_sales DESC, store_nbr LIMIT 10)
UNION ALL
(SELECT 'bottom' AS position, store_nbr, total_sales FROM performance
    ORDER BY total_sales, store_nbr DESC LIMIT 10)""",
    ),
    "type_perf": _query(
        "performance",
        """SELECT type, count(*) AS num_stores, sum(total_sales) AS total_sales,
    round_even(sum(total_sales) / count(*), 0) AS sale_per_store FROM performance GROUP BY type""",
    ),
    "city_perf": _query(
        "performance",
        """SELECT city, count(*) AS num_stores, round_even(sum(total_sales), 0) AS total_sales,
    CAST(sum(number_transactions) AS BIGINT) AS total_transactions FROM performance GROUP BY city
ORDER BY total_sales DESC, city LIMIT 10""",
    ),
    "concentration_stores": _query(
        "performance stores",
        f"""SELECT (SELECT count(*) FROM stores) AS n_stores, {_share("performance", "store_nbr")},
    CAST(5 AS DOUBLE) / (SELECT count(*) FROM stores) * 100 AS top5_stores_pct,
    CAST(10 AS DOUBLE) / (SELECT count(*) FROM stores) * 100 AS top10_stores_pct
FROM performance""",
    ),
    "family_perf": _query("families", "SELECT * FROM families"),
    "family_top15": _query(
        "families", "SELECT * FROM families ORDER BY total_sales DESC, family LIMIT 15"
    ),
    "concentration_families": _query(
        "families", f"SELECT {_share('families', 'family')} FROM families"
    ),
    "perishable_split": _query(
        "train items",
        """SELECT CAST(perishable AS INT) AS is_perishable,
    CASE perishable WHEN 0 THEN 'Non-Perishable' WHEN 1 THEN 'Perishable' END AS perishability,
    count(*) AS num_transactions, CAST(round(sum(unit_sales), 0) AS DOUBLE) AS total_sales,
    count(DISTINCT items.item_nbr) AS num_items,
    CAST(round(sum(unit_sales), 0) AS DOUBLE)
        / sum(CAST(round(sum(unit_sales), 0) AS DOUBLE)) OVER () * 100 AS sales_pct
FROM train JOIN items ON train.item_nbr = items.item_nbr GROUP BY perishable""",
    ),
    "promo_by_flag": _query("promotions", "SELECT * FROM promotions"),
    "promo_lift": _change(
        "promotions", "on_promotion", "avg_sales_per_transaction", "promotion_lift_pct"
    ),
    "q_pk_duplicates": _query(
        "stores items transactions oil train",
        "\nUNION ALL ".join(
            f"""SELECT '{table}' AS table_name, count(*) AS duplicate_keys
FROM (SELECT 1 FROM {table} GROUP BY {key} HAVING count(*) > 1) AS repeated"""
            for table, key in {
                "stores": "store_nbr",
                "items": "item_nbr",
                "transactions": "date, store_nbr",
                "oil": "date",
                "train": "id, date",
            }.items()
        ),
    ),
    "q_fk_orphans": _query(
        "train transactions stores items",
        "\nUNION ALL ".join(
            f"""SELECT '{child}.{key}' AS reference, count(DISTINCT {key}) AS orphan_keys,
    count(*) AS orphan_rows FROM {child} WHERE {key} NOT IN (SELECT {key} FROM {parent})"""
            for child, parent, key in (
                ("transactions", "stores", "store_nbr"),
                ("train", "stores", "store_nbr"),
                ("train", "items", "item_nbr"),
            )
        ),
    ),
    "q_nulls": _per_column(
        {
            "stores": "store_nbr city state type cluster",
            "items": "item_nbr family class perishable",
            "transactions": "date store_nbr transactions",
            "oil": "date",
            "holidays_events": "date type locale",
            "train": "id date store_nbr item_nbr unit_sales",
        },
        "count(*) - count({column})",
        "missing",
    ),
    "q_domain": _query(
        "items", "SELECT count(*) AS violations FROM items WHERE perishable NOT IN (0, 1)"
    ),
    "q_date_range": _query(
        "train",
        """SELECT count(*) AS violations FROM train
WHERE date < DATE '1995-01-01' OR date >= DATE '2002-01-01'""",
    ),
}


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
