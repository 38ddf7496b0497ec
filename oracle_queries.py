"""The same questions as plain SQL over the raw tables, written independently of the
Spark code, to check its results. Sums of doubles are exact on both sides."""

from __future__ import annotations

HOLIDAYS = "('01-01', '05-01', '07-04', '12-25')"

TICKS = "(CAST(round(l_extendedprice * 100) AS BIGINT) * 200 + CAST(l_quantity AS BIGINT)) // (2 * CAST(l_quantity AS BIGINT))"

STAR = f"""
trades AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey,
                   CAST(round(l_extendedprice * 100) AS BIGINT), CAST(l_quantity AS BIGINT),
                   strftime(l_shipdate, '%Y-%m-%d')) AS transaction_id,
         'STK' || lpad(CAST(l_partkey AS VARCHAR), 12, '0') AS stock_ticker,
         CASE WHEN l_returnflag = 'R' THEN 'SELL' ELSE 'BUY' END AS transaction_type,
         CAST(l_quantity AS BIGINT) AS quantity,
         CAST({TICKS} AS DOUBLE) / 10000 AS stock_price,
         l_extendedprice AS total_trade_amount,
         o_orderdate AS "timestamp",
         CAST(o_orderdate AS DATE) AS date,
         o_custkey AS customer_id,
         o_totalprice AS average_trade_size
  FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey),
dim_stock AS (
  SELECT 'STK' || lpad(CAST(p_partkey AS VARCHAR), 12, '0') AS stock_ticker,
         CASE WHEN p_size <= 16 THEN 'Low' WHEN p_size <= 33 THEN 'Mid' ELSE 'High' END AS liquidity_tier,
         p_type AS sector, p_brand AS industry
  FROM part),
stocks AS (
  SELECT t.*, c_mktsegment AS customer_account_type, dayname(date) AS day_name,
         isodow(date) >= 6 AS is_weekend, strftime(date, '%m-%d') IN {HOLIDAYS} AS is_holiday,
         liquidity_tier AS stock_liquidity_tier, sector AS stock_sector, industry AS stock_industry
  FROM trades t
  LEFT JOIN customer ON customer_id = c_custkey
  LEFT JOIN dim_stock USING (stock_ticker))
"""

PANEL = f"""
brands AS (SELECT DISTINCT p_brand AS stock_ticker FROM part WHERE p_brand IS NOT NULL),
cells AS (
  SELECT CAST(o_orderdate AS DATE) AS date, p_brand AS stock_ticker,
         CAST(sum({TICKS}) AS BIGINT) AS total, count(*) AS n
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
  GROUP BY 1, 2),
panel AS (
  SELECT d.date, b.stock_ticker, CAST((2 * total + n) // (2 * n) AS DOUBLE) / 10000 AS stock_price
  FROM (SELECT DISTINCT date FROM cells) d CROSS JOIN brands b
  LEFT JOIN cells c ON c.date = d.date AND c.stock_ticker = b.stock_ticker)
"""


def _fill(source: str, first: str = "ffill") -> str:
    last = f"last_value(stock_price IGNORE NULLS) OVER (PARTITION BY stock_ticker ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    nxt = f"first_value(stock_price IGNORE NULLS) OVER (PARTITION BY stock_ticker ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    order = f"{last}, {nxt}" if first == "ffill" else f"{nxt}, {last}"
    return f"SELECT date, stock_ticker, coalesce({order}) AS stock_price FROM {source}"


def _interpolate(source: str) -> str:
    until = "OVER (PARTITION BY stock_ticker ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    onward = "OVER (PARTITION BY stock_ticker ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    return f"""
    SELECT date, stock_ticker,
           coalesce(stock_price,
                    CASE WHEN b > a THEN pa + (pb - pa) * ((pos - a) / (b - a)) END, pa, pb) AS stock_price
    FROM (SELECT *,
                 last_value(CASE WHEN stock_price IS NOT NULL THEN pos END IGNORE NULLS) {until} AS a,
                 last_value(stock_price IGNORE NULLS) {until} AS pa,
                 first_value(CASE WHEN stock_price IS NOT NULL THEN pos END IGNORE NULLS) {onward} AS b,
                 first_value(stock_price IGNORE NULLS) {onward} AS pb
          FROM (SELECT *, row_number() OVER (PARTITION BY stock_ticker ORDER BY date) AS pos FROM {source}))"""


FILLED = f"filled AS ({_fill('panel')})"

# One row per trade and brand: what the customer holds of the brand after the trade.
HELD = """
brand_trades AS (
  SELECT transaction_id, "timestamp", date, customer_id, stock_industry AS stock_ticker,
         CASE WHEN transaction_type = 'BUY' THEN quantity ELSE -quantity END AS delta
  FROM stocks),
summed AS (
  SELECT t.transaction_id, t."timestamp", t.date, t.customer_id, b.stock_ticker,
         sum(CASE WHEN t.stock_ticker = b.stock_ticker THEN delta ELSE 0 END) OVER (
           PARTITION BY t.customer_id, b.stock_ticker ORDER BY t."timestamp", t.transaction_id
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS s
  FROM brand_trades t CROSS JOIN brands b),
held AS (
  SELECT *, CAST(s - least(0, min(s) OVER (
           PARTITION BY customer_id, stock_ticker ORDER BY "timestamp", transaction_id
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS BIGINT) AS quantity
  FROM summed)
"""

# Trades of days with holes, against the observed prices; portfolios valued at filled prices.
CHECKED = """
open_days AS (SELECT DISTINCT date FROM panel WHERE stock_price IS NULL),
checked AS (
  SELECT h.transaction_id, h."timestamp", h.customer_id, h.date,
         count(*) FILTER (WHERE p.stock_price IS NULL AND h.quantity > 0) AS missing_prices,
         coalesce(sum(p.stock_price * h.quantity), 0) AS known_value,
         sum(f.stock_price * h.quantity) AS portfolio_value,
         min(CASE WHEN p.stock_price IS NULL AND h.quantity > 0 THEN h.stock_ticker END) AS missing_ticker,
         min(CASE WHEN p.stock_price IS NULL AND h.quantity > 0 THEN h.quantity END) AS missing_quantity
  FROM held h JOIN open_days USING (date)
  JOIN panel p ON p.date = h.date AND p.stock_ticker = h.stock_ticker
  JOIN filled f ON f.date = h.date AND f.stock_ticker = h.stock_ticker
  GROUP BY ALL)
"""


def money(column: str) -> str:
    """The exact sum of doubles, as whole multiples of 2**-64."""
    units = "18446744073709551616.0::DOUBLE"
    return f"(CAST(sum(CAST({column} * {units} AS HUGEINT)) AS DOUBLE) / {units})"


def mean(column: str) -> str:
    return f"{money(column)} / count({column})"


def volume(column: str = "quantity") -> str:
    return f"CAST(sum({column}) AS BIGINT)"


AMOUNT = money("total_trade_amount")
ACTIVITY = f"{volume()} AS total_volume, {AMOUNT} AS total_amount, count(*) AS transaction_count"


def over_star(body: str, *more: str) -> str:
    return f"WITH {', '.join([STAR.strip(), *more])} {body}"


def over_panel(body: str, *more: str) -> str:
    return f"WITH {', '.join([PANEL.strip(), *more])} {body}"


def over_portfolio(body: str, *more: str) -> str:
    return over_star(body, PANEL, FILLED, HELD, *more)


def by(key: str, select: str, where: str = "TRUE") -> str:
    return over_star(f"SELECT {key}, {select} FROM stocks WHERE {where} GROUP BY {key}")


LABELS = ["stock_ticker", "transaction_type", "customer_account_type", "day_name", "stock_sector", "stock_industry"]
FLAGS = ["is_weekend", "is_holiday"]


def label_rows(source: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {c} AS original_value, "
        f"row_number() OVER (ORDER BY {c}) - 1 AS encoded_value FROM (SELECT DISTINCT {c} FROM {source})"
        for c in columns
    )


def flag_rows(source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT DISTINCT '{c}' AS column_name, CAST(CAST({c} AS INT) AS VARCHAR) AS original_value, "
        f"CAST({c} AS BIGINT) AS encoded_value FROM {source}"
        for c in FLAGS
    )


def encoded(source: str, codes: str, missing: str) -> str:
    """SELECT list and joins that code `source` by the table `codes`."""
    selected = ", ".join(
        f"CASE WHEN s.{c} IS NULL THEN {missing} ELSE coalesce(c{i}.encoded_value, -1) END AS {c}"
        for i, c in enumerate(LABELS)
    )
    joins = " ".join(
        f"LEFT JOIN {codes} c{i} ON c{i}.column_name = '{c}' AND c{i}.original_value = s.{c}"
        for i, c in enumerate(LABELS)
    )
    flags = ", ".join(f"CAST(s.{c} AS INT) AS {c}" for c in FLAGS)
    return f"{selected}, {flags} FROM {source} s {joins}"


SPLIT = """
ranked AS (
  SELECT *, row_number() OVER (ORDER BY md5('42:' || transaction_id), transaction_id)
              > floor((SELECT count(*) FROM stocks) * CAST(0.95 AS DOUBLE)) AS is_stream
  FROM stocks),
main AS (SELECT * FROM ranked WHERE NOT is_stream),
arriving AS (SELECT * FROM ranked WHERE is_stream)
"""

NUMBERS = ["quantity", "stock_price", "total_trade_amount", "average_trade_size"]


def long_numbers(columns: list[str]) -> str:
    parts = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST({c} AS DOUBLE) AS value FROM stocks" for c in columns
    )
    return f"long AS ({parts})"


def bounds(threshold: float) -> str:
    return f"""
quartiles AS (
  SELECT column_name, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM long GROUP BY 1),
bounds AS (
  SELECT *, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM quartiles),
outliers AS (
  SELECT column_name, q1, q3, lower, upper, count(*) AS row_count,
         count(*) FILTER (WHERE value < lower OR value > upper) AS outlier_count
  FROM long JOIN bounds USING (column_name) GROUP BY ALL),
judged AS (
  SELECT *, outlier_count / row_count AS outlier_share, outlier_count / row_count >= {threshold} AS flagged
  FROM outliers),
moments AS (
  SELECT column_name, avg(value) AS mean, stddev_samp(value) AS std_samp, stddev_pop(value) AS std_pop,
         min(value) AS low
  FROM long GROUP BY 1)
"""


def treated(change: str, digits: int) -> str:
    """`change` is an expression of x and of the parameter row p."""
    columns = ["stock_price", "total_trade_amount"]
    params = "params AS (SELECT * FROM judged JOIN moments USING (column_name))"
    selected = ", ".join(
        f"round(CASE WHEN p{i}.flagged THEN {change.replace("{x}", f"s.{c}").replace("{p}", f"p{i}")} ELSE s.{c} END, {digits}) + 0 AS {c}"
        for i, c in enumerate(columns)
    )
    joins = " ".join(f"JOIN params p{i} ON p{i}.column_name = '{c}'" for i, c in enumerate(columns))
    return over_star(
        f"SELECT transaction_id, {selected} FROM stocks s {joins}", long_numbers(columns), bounds(0.01), params
    )


_FACT_OF_PIPELINE = """transaction_id, "timestamp", customer_id, s.stock_ticker, transaction_type, quantity,
  round({size}, 4) AS average_trade_size, round({price}, 4) AS stock_price,
  round({price} * quantity, 4) AS total_trade_amount, customer_account_type, day_name,
  is_weekend, is_holiday, stock_liquidity_tier, stock_sector, stock_industry"""


def log_pipeline(panel: str, logged: str) -> str:
    """The fact with treated prices and sizes beside the restored ones.

    panel: prices of which the outliers are counted; logged: the prices that are used, logged
    where a ticker has enough outliers.
    """
    restored = "CASE WHEN f.flagged THEN exp(f.stock_price) - 1 ELSE f.stock_price END"
    return over_star(
        f"""SELECT {_FACT_OF_PIPELINE.format(size="average_trade_size", price=f"({restored})")},
                  round(f.stock_price, 4) AS treated_price,
                  round((average_trade_size - z.mean) / z.deviation, 4) + 0 AS treated_size
           FROM stocks s
           LEFT JOIN (SELECT l.*, flagged FROM {logged} l JOIN judged ON column_name = l.stock_ticker) f
             ON f.date = s.date AND f.stock_ticker = s.stock_industry
           CROSS JOIN (SELECT avg(average_trade_size) AS mean, stddev_samp(average_trade_size) AS deviation FROM trades) z""",
        PANEL,
        FILLED,
        f"long AS (SELECT stock_ticker AS column_name, stock_price AS value FROM {panel})",
        bounds(0.02),
        f"""logs AS (SELECT date, stock_ticker, CASE WHEN flagged THEN ln(1 + stock_price) ELSE stock_price END AS stock_price
            FROM {panel} JOIN judged ON column_name = stock_ticker)""",
        f"filled_logs AS ({_fill('logs')})",
    )


def inference(body: str, *more: str, rounds: int = 25) -> str:
    """Prices inferred from portfolios as `inferred` (date, stock_ticker, stock_price).

    In a round, every day's first trade behind the day's last deciding one that holds exactly
    one unpriced ticker decides its price. A day without such a trade is done, and a round
    decides one ticker per day, so there are as many rounds as tickers.
    """
    steps = [
        """positions AS MATERIALIZED (
          SELECT p.pos, h.date, h.stock_ticker, h.quantity
          FROM held h JOIN (SELECT transaction_id, row_number() OVER (ORDER BY customer_id, "timestamp", transaction_id) AS pos
                            FROM brand_trades) p ON p.transaction_id = h.transaction_id
          WHERE h.quantity > 0 AND h.date IN (SELECT date FROM panel WHERE stock_price IS NULL))""",
        """worth AS MATERIALIZED (
          SELECT pos, sum(f.stock_price * quantity) AS portfolio_value
          FROM positions p JOIN filled f ON f.date = p.date AND f.stock_ticker = p.stock_ticker GROUP BY pos)""",
        "state0 AS MATERIALIZED (SELECT date, stock_ticker, stock_price FROM panel)",
        "reach0 AS MATERIALIZED (SELECT DISTINCT date, CAST(0 AS BIGINT) AS pos FROM state0 WHERE stock_price IS NULL)",
    ]
    for r in range(rounds):
        steps += [
            f"""look{r} AS MATERIALIZED (
              SELECT p.pos, p.date, count(*) FILTER (WHERE s.stock_price IS NULL) AS missing,
                     coalesce(sum(s.stock_price * quantity), 0) AS known,
                     min(CASE WHEN s.stock_price IS NULL THEN p.stock_ticker END) AS ticker,
                     min(CASE WHEN s.stock_price IS NULL THEN quantity END) AS amount
              FROM positions p JOIN reach{r} r ON r.date = p.date AND p.pos > r.pos
              JOIN state{r} s ON s.date = p.date AND s.stock_ticker = p.stock_ticker GROUP BY p.pos, p.date)""",
            f"""hit{r} AS MATERIALIZED (
              SELECT date, min(pos) AS pos, arg_min(ticker, pos) AS ticker, arg_min(price, pos) AS price
              FROM (SELECT l.date, l.pos, ticker, (portfolio_value - known) / amount AS price
                    FROM look{r} l JOIN worth w ON w.pos = l.pos WHERE missing = 1)
              WHERE price > 0 AND price < 10000 GROUP BY date)""",
            f"""state{r + 1} AS MATERIALIZED (
              SELECT s.date, s.stock_ticker, coalesce(s.stock_price, CASE WHEN h.ticker = s.stock_ticker THEN h.price END) AS stock_price
              FROM state{r} s LEFT JOIN hit{r} h ON h.date = s.date)""",
            f"reach{r + 1} AS MATERIALIZED (SELECT date, pos FROM hit{r})",
        ]
    return over_portfolio(body, *steps, f"inferred AS (SELECT * FROM state{rounds})", *more)


def profile() -> str:
    columns = {
        "transaction_id": "text", "timestamp": "time", "customer_id": "number", "stock_ticker": "text", "transaction_type": "text",
        "quantity": "number", "average_trade_size": "number", "stock_price": "number", "total_trade_amount": "number",
        "customer_account_type": "text", "day_name": "text", "is_weekend": "text", "is_holiday": "text",
        "stock_liquidity_tier": "text", "stock_sector": "text", "stock_industry": "text",
    }
    parts = []
    for c, kind in columns.items():
        common = (
            f"(SELECT string_agg(v, '|' ORDER BY n DESC, v) FROM (SELECT CAST({c} AS VARCHAR) AS v, count(*) AS n "
            f"FROM stocks WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY n DESC, v LIMIT 5))"
            if kind == "text"
            else "CAST(NULL AS VARCHAR)"
        )
        low, high = (f"CAST(min({c}) AS DOUBLE)", f"CAST(max({c}) AS DOUBLE)") if kind == "number" else ("CAST(NULL AS DOUBLE)",) * 2
        parts.append(
            f"SELECT '{c}' AS column_name, count(*) AS row_count, count(DISTINCT {c}) AS unique_values, "
            f"count(*) - count({c}) AS null_count, {common} AS common_values, {low} AS min_value, {high} AS max_value FROM stocks"
        )
    return over_star(" UNION ALL ".join(parts))


_WEEKDAYS = "NOT is_weekend"
_TREE = """SELECT {a}, {b}, CAST(grouping({a}, {b}) AS BIGINT) AS level, {amount} AS total_amount
           FROM stocks GROUP BY ROLLUP ({a}, {b})"""
_LOG_ROWS = """SELECT strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS "timestamp", 'question ' || event_id AS user_query,
  CASE WHEN event_type <> 'error' THEN props END AS generated_sql, value AS execution_time_ms,
  CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS status,
  CASE WHEN event_type = 'error' THEN props END AS error FROM events"""


def oracle_sql() -> dict[str, str]:
    stage = "transaction_id, \"timestamp\", customer_id, stock_ticker, transaction_type, quantity, average_trade_size"
    fact = (
        stage + ", stock_price, total_trade_amount, customer_account_type, day_name, is_weekend, is_holiday, "
        "stock_liquidity_tier, stock_sector, stock_industry"
    )
    volume_rank = by("stock_ticker", f"{volume()} AS total_volume")
    brand_columns = ", ".join(
        f"max(CASE WHEN stock_ticker = 'Brand#{i}' THEN stock_price END) AS Brand_{i}" for i in range(1, 26)
    )
    median = lambda c: f"round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 8) AS {c}_median"
    candidates = """SELECT *, (portfolio_value - known_value) / missing_quantity AS inferred_price
                    FROM checked WHERE missing_prices = 1"""
    sql: dict[str, str] = {
        # sources and sinks
        "src_csv": over_star(f"SELECT {stage} FROM trades"),
        "src_star": over_star(
            """SELECT 'trades' AS table_name, concat_ws('|', transaction_id, strftime("timestamp", '%Y-%m-%d %H:%M:%S'), customer_id,
                 stock_ticker, transaction_type, quantity, CAST(average_trade_size AS DECIMAL(18, 4)), 'null') AS row_text FROM trades
               UNION ALL SELECT 'dim_customer', concat_ws('|', c_custkey, c_custkey, c_mktsegment) FROM customer
               UNION ALL SELECT 'dim_stock', concat_ws('|', p_partkey, 'STK' || lpad(CAST(p_partkey AS VARCHAR), 12, '0'), p_name,
                   CASE WHEN p_size <= 16 THEN 'Low' WHEN p_size <= 33 THEN 'Mid' ELSE 'High' END, p_type, p_brand) FROM part
               UNION ALL SELECT 'dim_date', concat_ws('|', strftime(d, '%Y%m%d'), d, day(d), month(d), monthname(d), quarter(d), year(d),
                   isodow(d), dayname(d), isodow(d) >= 6, strftime(d, '%m-%d') IN HOLIDAYS)
                 FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)
               UNION ALL SELECT 'daily_trade_prices', date || '|' ||
                   string_agg(coalesce(CAST(CAST(stock_price AS DECIMAL(18, 4)) AS VARCHAR), 'null'), '|' ORDER BY stock_ticker)
                 FROM panel GROUP BY date""".replace("HOLIDAYS", HOLIDAYS),
            PANEL,
        ),
        "src_csv_infer": over_star("SELECT transaction_id, customer_id, quantity, stock_price, transaction_type FROM trades"),
        "src_frame_to_spark": over_star(
            "SELECT transaction_id, transaction_type, stock_sector, is_holiday, dense_rank() OVER (ORDER BY stock_sector) - 1 AS sector_code FROM stocks"
        ),
        "src_view": by("stock_sector", f"{volume()} AS volume, count(*) AS n"),
        "src_preview": over_star(f"SELECT {fact} FROM stocks ORDER BY transaction_id LIMIT 10"),
        "src_fallback": over_star("SELECT transaction_id, stock_ticker, quantity FROM trades"),
        "src_json_logs": f"SELECT * FROM ({_LOG_ROWS}) ORDER BY \"timestamp\" DESC, user_query LIMIT 10",
        "agg_querylog_metrics": f"""SELECT count(*) AS total_queries, count(*) FILTER (WHERE status = 'success') AS successful_queries,
            count(*) FILTER (WHERE status <> 'success') AS failed_queries, round(avg(execution_time_ms), 6) AS avg_execution_time,
            max("timestamp") AS last_updated FROM ({_LOG_ROWS})""",
        "src_lookup": over_star(f"SELECT * FROM ({label_rows('stocks', ['stock_sector'])})"),
        "src_table_info": """SELECT CAST(unnest([0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10]) AS INT) AS position,
            unnest(['l_orderkey', 'l_partkey', 'l_suppkey', 'l_linenumber', 'l_quantity', 'l_extendedprice',
                    'l_discount', 'l_tax', 'l_returnflag', 'l_linestatus', 'l_shipdate']) AS column_name,
            unnest(['bigint', 'bigint', 'bigint', 'int', 'double', 'double', 'double', 'double', 'string', 'string',
                    'timestamp_ntz']) AS data_type,
            TRUE AS nullable, (SELECT count(*) FROM lineitem) AS row_count""",
        "snk_file_csv": volume_rank,
        "snk_file_parquet": volume_rank,
        "snk_file_json": volume_rank,
        "snk_result": over_star(
            f"""SELECT stock_sector, {mean('stock_price')} AS average_price, place
                FROM stocks CROSS JOIN (VALUES ('files'), ('table')) p(place) GROUP BY stock_sector, place"""
        ),
        "snk_csv_sample": over_star(
            "SELECT transaction_id, customer_id, quantity, total_trade_amount FROM trades ORDER BY transaction_id LIMIT 10"
        ),
        "snk_csv_full": over_star("SELECT transaction_id, customer_id, stock_sector, quantity, total_trade_amount FROM stocks"),
        "snk_lookup": over_star(f"SELECT * FROM ({label_rows('stocks', LABELS)} UNION ALL {flag_rows('stocks')})"),
        "snk_query_result": by("stock_industry", f"{volume()} AS volume"),
        # projections and filters
        "prj_base": over_star(f"SELECT {stage} FROM trades"),
        "prj_dims": over_star("SELECT stock_ticker, liquidity_tier, sector, industry FROM dim_stock"),
        "prj_amount": over_star("SELECT transaction_id, stock_price * quantity AS total_trade_amount FROM trades"),
        "prj_rename": over_star(
            "SELECT stock_ticker, transaction_id, stock_liquidity_tier, stock_sector, stock_industry FROM stocks"
        ),
        "prj_drop": over_star("SELECT transaction_id, quantity FROM trades"),
        "prj_exp_price": over_star("SELECT transaction_id, stock_price AS stock_price_original FROM trades"),
        "prj_case_holiday": over_star(
            "SELECT transaction_id, CASE WHEN is_holiday THEN 'Holiday' ELSE 'Non-Holiday' END AS period_type FROM stocks"
        ),
        "prj_day_name_ts": over_star("SELECT transaction_id, dayname(\"timestamp\") AS day_of_week FROM trades"),
        "flt_weekend": over_star("SELECT transaction_id FROM stocks WHERE is_weekend"),
        "flt_fallback": by("transaction_type", "count(*) AS count", _WEEKDAYS),
        "flt_date_range": over_star("SELECT transaction_id, \"timestamp\" FROM trades WHERE year(date) = 1997"),
        "flt_in": over_star("SELECT transaction_id, stock_sector FROM stocks WHERE stock_sector IN ('PROMO', 'SMALL')"),
        "flt_industry": over_star("SELECT transaction_id, stock_industry FROM stocks WHERE stock_industry IN ('Brand#3', 'Brand#14')"),
        "flt_eq": over_star(
            "SELECT transaction_id, customer_account_type, transaction_type FROM stocks "
            "WHERE customer_account_type = 'BUILDING' AND transaction_type = 'SELL'"
        ),
        "flt_all": over_star(
            f"""SELECT count(*) AS total_transactions, coalesce({AMOUNT}, 0) AS total_trade_volume,
                count(DISTINCT stock_ticker) AS unique_stocks, count(DISTINCT customer_id) AS active_customers,
                {mean('stock_price')} AS avg_stock_price FROM stocks
                WHERE date BETWEEN DATE '1996-01-01' AND DATE '1999-06-30' AND stock_sector IN ('PROMO', 'LARGE')
                  AND customer_account_type = 'BUILDING' AND transaction_type = 'BUY'"""
        ),
        "flt_having": over_star(
            "SELECT customer_id, count(*) AS transaction_count FROM trades GROUP BY 1 HAVING count(*) > 40"
        ),
        "flt_not_null": by("stock_sector", f"{volume()} AS total_volume", "stock_sector <> 'SMALL'"),
        "flt_negative": """SELECT 'c_custkey' AS column_name, count(*) FILTER (WHERE c_custkey < 0) AS negative_count FROM customer
            UNION ALL SELECT 'c_acctbal', count(*) FILTER (WHERE c_acctbal < 0) FROM customer""",
        "flt_invalid_date": """SELECT count(*) AS rows, CAST(0 AS BIGINT) AS missing,
            count(*) FILTER (WHERE event_type = 'error') AS invalid FROM events""",
        "flt_key_mismatch": "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey <> o_custkey",
        "flt_ilike": by("stock_sector", "count(*) AS transaction_count", "stock_sector ILIKE '%ar%'"),
        "flt_const_sector": over_star(
            f"SELECT {volume()} AS total_volume, count(*) AS transaction_count FROM stocks "
            "WHERE stock_sector = 'PROMO' AND stock_industry = 'Brand#7'"
        ),
        "flt_distinct_values": over_star(
            " UNION ALL ".join(
                f"SELECT DISTINCT '{c}' AS column_name, {c} AS value FROM stocks"
                for c in ["stock_ticker", "stock_sector", "customer_account_type", "transaction_type"]
            )
        ),
        # joins
        "jn_price": over_star(
            """SELECT transaction_id, "timestamp", stock_industry, p.stock_price FROM stocks s
               LEFT JOIN panel p ON p.date = s.date AND p.stock_ticker = s.stock_industry""",
            PANEL,
        ),
        "jn_customer": over_star("SELECT customer_id, transaction_id, customer_account_type AS account_type FROM stocks"),
        "jn_date": over_star("SELECT transaction_id, \"timestamp\", day_name, is_weekend, is_holiday FROM stocks"),
        "jn_stock": over_star(
            "SELECT stock_ticker, transaction_id, liquidity_tier, sector, industry FROM trades LEFT JOIN dim_stock USING (stock_ticker)"
        ),
        "jn_integrate": over_star(
            f"""SELECT {fact.replace("stock_ticker", "s.stock_ticker", 1).replace("stock_price, total_trade_amount", "f.stock_price, f.stock_price * quantity AS total_trade_amount")}
                FROM stocks s LEFT JOIN filled f ON f.date = s.date AND f.stock_ticker = s.stock_industry""",
            PANEL,
            FILLED,
        ),
        "jn_encode": over_star(
            """SELECT transaction_id,
                 CASE stock_sector WHEN 'ECONOMY' THEN 0 WHEN 'LARGE' THEN 1 WHEN 'PROMO' THEN 2 ELSE -1 END AS stock_sector,
                 CASE transaction_type WHEN 'SELL' THEN 0 ELSE -1 END AS transaction_type FROM stocks"""
        ),
        "jn_decode": over_star(
            f"""SELECT p_partkey, coalesce(original_value, CAST(p_size % 7 AS VARCHAR)) AS stock_sector
                FROM part LEFT JOIN ({label_rows('stocks', ['stock_sector'])}) ON encoded_value = p_size % 7"""
        ),
        "jn_holdings_prices": over_portfolio(
            """SELECT transaction_id, date, CAST(missing_prices AS INT) AS missing_prices, round(known_value, 4) AS known_value,
                 CASE WHEN missing_prices = 1 THEN missing_ticker END AS missing_ticker,
                 CASE WHEN missing_prices = 1 THEN missing_quantity END AS missing_quantity FROM checked""",
            CHECKED,
        ),
        # questions and analyses
        "q1_volume_by_ticker": volume_rank,
        "q2_avg_price_by_sector": by("stock_sector", f"{mean('stock_price')} AS average_price"),
        "q2b_avg_price_onehot": over_star(
            """SELECT stock_sector AS sector, round(avg(stock_price), 4) AS avg_price_original,
                      round(avg(ln(1 + stock_price)), 6) AS avg_price_logged FROM stocks GROUP BY 1"""
        ),
        "q3_weekend_buy_sell": by("transaction_type", "count(*) AS transaction_count", "is_weekend"),
        "q3_weekend_total": over_star("SELECT count(*) AS weekend_transactions FROM stocks WHERE is_weekend"),
        "q3b_weekend_fallback": by("transaction_type", "count(*) AS count", "is_weekend"),
        "q4_active_customers": over_star(
            "SELECT customer_id, count(*) AS transaction_count FROM trades GROUP BY 1 HAVING count(*) > 10"
        ),
        "q5_amount_by_day": by("day_name", f"{AMOUNT} AS total_trade_amount"),
        "q5b_amount_by_day_ts": over_star(
            f"SELECT dayname(\"timestamp\") AS day_of_week, {AMOUNT} AS total_trade_amount FROM trades GROUP BY 1"
        ),
        "sql_q1_top5": over_star(
            f"SELECT stock_ticker, {volume()} AS total_quantity FROM trades GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5"
        ),
        "sql_q2_avg_by_account": by(
            "customer_account_type", f"{mean('total_trade_amount')} AS avg_trade_amount, count(*) AS transaction_count"
        ),
        "sql_q3_holiday": over_star(
            f"""SELECT CASE WHEN is_holiday THEN 'Holiday' ELSE 'Non-Holiday' END AS period_type,
                count(*) AS transaction_count, {AMOUNT} AS total_trade_amount FROM stocks GROUP BY is_holiday"""
        ),
        "sql_q3b_holiday_flag": by("is_holiday", "count(*) AS transactions_count"),
        "sql_q4_weekend_sector": by(
            "stock_sector",
            f"{volume()} AS total_weekend_volume, count(*) AS weekend_transactions, {AMOUNT} AS total_weekend_value",
            "is_weekend",
        ),
        "sql_q4b_fallback": by("stock_sector", f"{volume()} AS total_volume", "is_weekend"),
        "sql_q4b_fallback_taken": by("stock_sector", f"{volume()} AS total_volume", _WEEKDAYS),
        "sql_q5_liquidity_type": over_star(
            f"""SELECT stock_liquidity_tier, transaction_type, {AMOUNT} AS total_amount, count(*) AS transaction_count,
                {mean('total_trade_amount')} AS avg_amount FROM stocks GROUP BY 1, 2"""
        ),
        "sql_q5b_liquidity_pivot": by(
            "stock_liquidity_tier",
            f"""{money("CASE WHEN transaction_type = 'BUY' THEN total_trade_amount ELSE 0 END")} AS buy_amount,
                {money("CASE WHEN transaction_type = 'SELL' THEN total_trade_amount ELSE 0 END")} AS sell_amount""",
        ),
        "sql_q5c_liquidity_pivot_full": by(
            "stock_liquidity_tier",
            f"""{money("CASE WHEN transaction_type = 'BUY' THEN total_trade_amount ELSE 0 END")} AS total_buy_amount,
                {money("CASE WHEN transaction_type = 'SELL' THEN total_trade_amount ELSE 0 END")} AS total_sell_amount,
                {AMOUNT} AS total_amount,
                count(*) FILTER (WHERE transaction_type = 'BUY') AS buy_count,
                count(*) FILTER (WHERE transaction_type = 'SELL') AS sell_count""",
        ),
        "types_distinct": over_star("SELECT DISTINCT transaction_type FROM trades"),
        "an_stock_perf": by(
            "stock_ticker",
            f"""count(*) AS total_transactions, {volume()} AS total_volume, {mean('stock_price')} AS avg_price,
                max(stock_price) AS max_price, min(stock_price) AS min_price,
                round(stddev_samp(stock_price), 4) AS price_volatility, {AMOUNT} AS total_value""",
        ),
        "an_sector": by(
            "stock_sector",
            f"count(*) AS total_transactions, {AMOUNT} AS total_value, {mean('stock_price')} AS avg_price, count(DISTINCT stock_ticker) AS unique_stocks",
        ),
        "an_customer_type": by(
            "customer_account_type",
            f"count(*) AS total_transactions, {AMOUNT} AS total_value, {mean('quantity')} AS avg_quantity, count(DISTINCT customer_id) AS unique_customers",
        ),
        "an_temporal": over_star(
            f"""SELECT day_name, is_weekend, count(*) AS total_transactions, {AMOUNT} AS total_value,
                {mean('stock_price')} AS avg_price FROM stocks GROUP BY 1, 2"""
        ),
        # roll-ups and dashboard
        "agg_volume_by_ticker": by("stock_ticker", ACTIVITY),
        "agg_price_by_sector": over_star(
            f"""SELECT stock_sector, "timestamp", {mean('stock_price')} AS stock_price, {AMOUNT} AS total_trade_amount
                FROM stocks GROUP BY 1, 2"""
        ),
        "agg_buy_vs_sell": by("transaction_type", ACTIVITY.replace("total_volume", "total_quantity")),
        "agg_trading_by_day": by("day_name", ACTIVITY),
        "agg_day_ordered": over_star(
            f"SELECT day_name, {ACTIVITY}, CAST(isodow(date) AS INT) AS day_position FROM stocks GROUP BY day_name, isodow(date)"
        ),
        "agg_customer_distribution": by(
            "customer_id",
            f"{AMOUNT} AS total_amount, count(*) AS transaction_count, arg_min(customer_account_type, transaction_id) AS account_type",
        ),
        "agg_top10_customers": over_star(
            f"""SELECT customer_id, {AMOUNT} AS total_amount, count(*) AS transaction_count,
                arg_min(customer_account_type, transaction_id) AS account_type
                FROM stocks GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"""
        ),
        "agg_holiday_comparison": over_star(
            f"""SELECT CASE WHEN is_holiday THEN 'Holiday' ELSE 'Non-Holiday' END AS is_holiday,
                {volume()} AS total_quantity, {AMOUNT} AS total_amount, count(*) AS transaction_count FROM stocks GROUP BY 1"""
        ),
        "agg_holiday_stats": over_star(
            """SELECT status, transaction_count, total_volume, total_amount, avg_amount,
                 round((max(CASE WHEN status = 'Holiday' THEN avg_amount END) OVER ()
                   - max(CASE WHEN status <> 'Holiday' THEN avg_amount END) OVER ())
                   / max(CASE WHEN status <> 'Holiday' THEN avg_amount END) OVER () * 100, 6) AS difference_percent
               FROM stats""",
            f"""stats AS (SELECT CASE WHEN is_holiday THEN 'Holiday' ELSE 'Non-Holiday' END AS status,
                count(*) AS transaction_count, {volume()} AS total_volume, {AMOUNT} AS total_amount,
                {mean('total_trade_amount')} AS avg_amount FROM stocks GROUP BY 1)""",
        ),
        "agg_sector_comparison": by(
            "stock_sector",
            f"{AMOUNT} AS total_amount, {mean('total_trade_amount')} AS avg_amount, {volume()} AS total_volume, count(*) AS transaction_count",
        ),
        "agg_sector_metrics": over_star(
            f"""SELECT stock_sector AS sector, count(*) AS transactions, {volume()} AS volume, {AMOUNT} AS total_amount,
                {mean('stock_price')} AS avg_price FROM stocks GROUP BY 1"""
        ),
        "agg_sector_minmax": over_star(
            "SELECT sector, "
            + ", ".join(
                f"round(CASE WHEN max({c}) OVER () = min({c}) OVER () THEN 0 ELSE ({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ()) END, 6) AS {c}"
                for c in ["transactions", "volume", "total_amount", "avg_price"]
            )
            + " FROM metrics QUALIFY count(*) OVER () >= 3",
            f"""metrics AS (SELECT stock_sector AS sector, count(*) AS transactions, {volume()} AS volume,
                {AMOUNT} AS total_amount, {mean('stock_price')} AS avg_price FROM stocks GROUP BY 1)""",
        ),
        "agg_liquidity_daily": over_star(
            f"""SELECT stock_liquidity_tier, "timestamp", {AMOUNT} AS total_trade_amount, {volume()} AS quantity
                FROM stocks GROUP BY 1, 2"""
        ),
        "agg_liquidity_dist": over_star(f"SELECT stock_liquidity_tier AS liquidity_tier, {ACTIVITY} FROM stocks GROUP BY 1"),
        "agg_sunburst": over_star(_TREE.format(a="stock_liquidity_tier", b="stock_sector", amount=AMOUNT)),
        "agg_sector_industry_tree": over_star(_TREE.format(a="stock_sector", b="stock_industry", amount=AMOUNT)),
        "agg_summary": over_star(
            f"""SELECT count(*) AS total_transactions, min("timestamp") AS first_timestamp, max("timestamp") AS last_timestamp,
                count(DISTINCT stock_ticker) AS unique_stocks, count(DISTINCT customer_id) AS unique_customers,
                {volume()} AS total_volume, {AMOUNT} AS total_trade_amount FROM trades"""
        ),
        "agg_kpi": over_star(
            f"""SELECT count(*) AS total_transactions, {AMOUNT} AS total_trade_volume,
                count(DISTINCT stock_ticker) AS unique_stocks, count(DISTINCT customer_id) AS active_customers,
                {mean('stock_price')} AS avg_stock_price FROM trades"""
        ),
        "agg_volume_top_bottom5": over_star(
            """SELECT * FROM (SELECT *, 'top' AS side FROM v ORDER BY quantity DESC, stock_ticker LIMIT 5)
               UNION ALL SELECT * FROM (SELECT *, 'bottom' AS side FROM v ORDER BY quantity, stock_ticker DESC LIMIT 5)""",
            f"v AS (SELECT stock_ticker, {volume()} AS quantity FROM trades GROUP BY 1)",
        ),
        "agg_price_trend": over_star(f"SELECT date, stock_sector, {mean('stock_price')} AS avg_price FROM stocks GROUP BY 1, 2"),
        "agg_sector_price_stats": by(
            "stock_sector",
            f"""{mean('stock_price')} AS avg_price, min(stock_price) AS min_price, max(stock_price) AS max_price,
                round(stddev_samp(stock_price), 4) AS std_price""",
        ),
        "agg_type_counts": by("transaction_type", f"count(*) AS transaction_count, {AMOUNT} AS total_trade_amount"),
        "agg_customer_hist": over_star(
            """SELECT b.bin, round(low + width * b.bin, 4) AS lower, round(low + width * (b.bin + 1), 4) AS upper,
                      coalesce(customers, 0) AS customers
               FROM (SELECT i AS bin FROM range(0, 50) r(i)) b CROSS JOIN ends LEFT JOIN counted c ON c.bin = b.bin""",
            f"totals AS (SELECT customer_id, {AMOUNT} AS total FROM trades GROUP BY 1)",
            "ends AS (SELECT min(total) AS low, (max(total) - min(total)) / 50 AS width FROM totals)",
            """counted AS (SELECT least(CAST(floor((total - low) / width) AS BIGINT), 49) AS bin, count(*) AS customers
                           FROM totals CROSS JOIN ends GROUP BY 1)""",
        ),
        "agg_recent_hourly": over_star(
            """SELECT date_trunc('hour', "timestamp") AS hour, count(*) AS trades
               FROM (SELECT "timestamp" FROM trades ORDER BY "timestamp" DESC, transaction_id DESC LIMIT 100) GROUP BY 1"""
        ),
        "agg_recent_rows": over_star(
            """SELECT "timestamp", stock_ticker, transaction_type, quantity, stock_price, total_trade_amount
               FROM trades ORDER BY "timestamp" DESC, transaction_id DESC LIMIT 20"""
        ),
        "agg_monthly_price": over_star(
            f"""SELECT strftime("timestamp", '%Y-%m') AS year_month, stock_ticker, {mean('stock_price')} AS avg_price
                FROM trades GROUP BY 1, 2"""
        ),
        "agg_stock_stats": by(
            "stock_ticker",
            f"""{mean('stock_price')} AS stock_price_mean, {median('stock_price')},
                round(stddev_samp(stock_price), 4) AS stock_price_std, {mean('quantity')} AS quantity_mean,
                {median('quantity')}, {mean('total_trade_amount')} AS total_trade_amount_mean, {median('total_trade_amount')}""",
        ),
        "agg_weekend_weekday": by("is_weekend", ACTIVITY),
        "agg_avg_trade_size": over_star(f"SELECT {mean('quantity')} AS avg_trade_size FROM trades"),
        "agg_top_customers_volume": over_star(
            f"SELECT customer_id, {volume()} AS total_volume FROM trades GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"
        ),
        "agg_heatmap": by(
            "day_name",
            ", ".join(
                f"count(*) FILTER (WHERE stock_sector = '{s}') AS {s}"
                for s in ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
            ),
        ),
        # templates
        "tpl_tech_volume": over_star(f"SELECT {volume()} AS total_volume FROM stocks WHERE stock_sector = 'PROMO'"),
        "tpl_ticker_volume_top20": f"{volume_rank} ORDER BY 2 DESC, 1 LIMIT 20",
        "tpl_sector_avg_price": by("stock_sector", f"{mean('stock_price')} AS avg_price"),
        "tpl_account_avg_amount": by("customer_account_type", f"{mean('total_trade_amount')} AS avg_amount"),
        "tpl_top10_customers": f"{by('customer_id', f'{AMOUNT} AS total_trades')} ORDER BY 2 DESC, 1 LIMIT 10",
        "tpl_top10_tickers": f"{volume_rank} ORDER BY 2 DESC, 1 LIMIT 10",
        "tpl_weekend_types": by("transaction_type", "count(*) AS count", "is_weekend"),
        "tpl_holiday_count": over_star("SELECT count(*) AS holiday_trades FROM stocks WHERE is_holiday"),
        "tpl_sector_default": f"{by('stock_sector', f'count(*) AS transaction_count, {AMOUNT} AS total_amount')} ORDER BY 3 DESC, 1 LIMIT 10",
        "tpl_sector_volume_top10": f"{by('stock_sector', f'{volume()} AS total_volume')} ORDER BY 2 DESC, 1 LIMIT 10",
        "tpl_type_by_account": over_star(
            f"""SELECT customer_account_type, transaction_type, count(*) AS transaction_count, {AMOUNT} AS total_amount
                FROM stocks GROUP BY 1, 2"""
        ),
        "tpl_volume_by_month": over_star(
            f"SELECT strftime(\"timestamp\", '%Y-%m') AS year_month, {volume()} AS total_volume FROM trades GROUP BY 1"
        ),
        "tpl_holiday_rows": over_star(
            "SELECT transaction_id, customer_id, stock_ticker, transaction_type, quantity, total_trade_amount FROM stocks WHERE is_holiday"
        ),
        "tpl_sector_liquidity": by(
            "stock_sector", f"count(*) AS high_tier_trades, {volume()} AS high_tier_volume", "stock_liquidity_tier = 'High'"
        ),
        "tpl_top10_customers_count": f"{by('customer_id', 'count(*) AS transaction_count')} ORDER BY 2 DESC, 1 LIMIT 10",
        "tpl_weekend_count": over_star("SELECT count(*) AS weekend_transactions FROM stocks WHERE is_weekend"),
        "tpl_weekend_buys": over_star(
            "SELECT count(*) AS weekend_buys FROM stocks WHERE is_weekend AND transaction_type = 'BUY'"
        ),
        "adhoc_sql": over_star(
            "SELECT stock_sector, stock_liquidity_tier, max(quantity) AS largest, count(*) AS n FROM stocks GROUP BY 1, 2"
        ),
        # windows
        "win_ffill": over_panel(_fill("panel")),
        "win_bfill": over_panel(_fill("panel", "bfill")),
        "win_interpolate": over_panel(_interpolate("panel")),
        "win_position": over_portfolio(
            """SELECT h.transaction_id, h.customer_id, h.stock_ticker, h.quantity AS holding
               FROM held h JOIN brand_trades t ON t.transaction_id = h.transaction_id AND t.stock_ticker = h.stock_ticker"""
        ),
        "win_portfolio_map": over_portfolio(
            """SELECT transaction_id,
                 coalesce(string_agg(stock_ticker || '=' || quantity, ',' ORDER BY stock_ticker) FILTER (WHERE quantity > 0), '') AS holdings
               FROM held GROUP BY 1"""
        ),
        "win_price_candidates": over_portfolio(
            f"""SELECT date, missing_ticker AS stock_ticker,
                 round(arg_min(inferred_price, row(customer_id, "timestamp", transaction_id)), 4) AS inferred_price,
                 arg_min(transaction_id, row(customer_id, "timestamp", transaction_id)) AS transaction_id
               FROM ({candidates}) WHERE inferred_price > 0 AND inferred_price < 10000 GROUP BY 1, 2""",
            CHECKED,
        ),
        "win_price_inference": inference(
            """SELECT i.date, i.stock_ticker, round(i.stock_price, 4) AS stock_price
               FROM inferred i JOIN panel p ON p.date = i.date AND p.stock_ticker = i.stock_ticker
               WHERE p.stock_price IS NULL AND i.stock_price IS NOT NULL"""
        ),
        "win_label_codes": over_star(f"SELECT * FROM ({label_rows('stocks', LABELS)})"),
        # sets
        "set_append": over_star(
            """SELECT transaction_id, transaction_type, quantity,
                 CASE WHEN transaction_type = 'SELL' THEN stock_price END AS stock_price FROM trades"""
        ),
        "set_split": over_star("SELECT transaction_id, is_stream FROM ranked", SPLIT),
        "set_duplicates": """SELECT CAST(sum(n - 1) AS BIGINT) AS duplicate_rows FROM (
            SELECT count(*) AS n FROM (SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_returnflag = 'R'
                                       UNION ALL SELECT * FROM lineitem WHERE l_linenumber = 1)
            GROUP BY l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
                     l_returnflag, l_linestatus, l_shipdate)""",
        "set_distinct": over_star("SELECT DISTINCT stock_sector, transaction_type FROM stocks"),
        # scalar functions
        "fn_math": over_star(
            """SELECT transaction_id, round(ln(1 + stock_price), 8) AS log1p, stock_price AS restored,
                 round(exp(stock_price / 10000), 8) AS exp, round(ln(stock_price + 1), 8) AS log_offset,
                 greatest(least(stock_price, CAST(2000 AS DOUBLE)), CAST(100 AS DOUBLE)) AS clipped FROM trades"""
        ),
        "fn_date": """SELECT event_id, CAST(ts AS DATE) AS date, CAST(year(ts) AS INT) AS year, CAST(month(ts) AS INT) AS month,
            monthname(ts) AS month_name, strftime(ts, '%Y-%m') AS year_month, dayname(ts) AS day_name,
            date_trunc('hour', ts) AS hour FROM events""",
        "fn_json": """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, CAST(json_extract(props, '$.k') AS BIGINT) AS k_by_path,
            event_type, value FROM events""",
        "fn_melt": over_panel("SELECT date, stock_ticker, stock_price FROM panel"),
        "fn_pivot": over_panel(f"SELECT date, {brand_columns} FROM panel GROUP BY date"),
        # quality and transforms
        "dq_nulls": over_panel(
            "SELECT stock_ticker AS column_name, count(*) - count(stock_price) AS null_count FROM panel GROUP BY 1"
        ),
        "dq_outliers_iqr": over_star(
            """SELECT column_name, round(q1, 8) AS q1, round(q3, 8) AS q3, round(lower, 8) AS lower, round(upper, 8) AS upper,
                 row_count, outlier_count, round(outlier_share, 8) AS outlier_share, flagged FROM judged""",
            long_numbers(NUMBERS),
            bounds(0.01),
        ),
        "dq_outliers_z": over_star(
            """SELECT column_name, count(*) FILTER (WHERE abs((value - mean) / std_pop) > 2.5) AS outlier_count
               FROM long JOIN moments USING (column_name) GROUP BY 1""",
            long_numbers(NUMBERS),
            bounds(0.01),
        ),
        "dq_describe": over_star(
            f"""SELECT column_name, count(value) AS count, round(avg(value), 4) AS mean, round(stddev_samp(value), 4) AS std,
                 min(value) AS min, max(value) AS max, round(quantile_cont(value, 0.25), 8) AS q25,
                 round(quantile_cont(value, 0.5), 8) AS q50, round(quantile_cont(value, 0.75), 8) AS q75
               FROM long GROUP BY 1""",
            long_numbers(NUMBERS),
        ),
        "dq_value_counts": over_star("SELECT quantity, count(*) AS frequency FROM trades GROUP BY 1"),
        "dq_profile": profile(),
        "dq_reconcile": over_star(
            """SELECT rows_before, processed, rows_after, rows_after - rows_before = processed AS matches
               FROM (SELECT (SELECT count(*) FROM main) AS rows_before, (SELECT count(*) FROM arriving) AS processed,
                            (SELECT count(*) FROM stocks) AS rows_after)""",
            SPLIT,
        ),
        "tf_cap": treated("greatest(least({x}, {p}.upper), {p}.lower)", 8),
        "tf_log": treated("ln(1 + {x})", 6),
        "tf_log_offset": """SELECT c_custkey, round(ln(c_acctbal + CASE WHEN low <= 0 THEN 1 - low ELSE 0 END), 6) + 0 AS c_acctbal
            FROM customer CROSS JOIN (SELECT min(c_acctbal) AS low FROM customer)""",
        "tf_zscore": treated("({x} - {p}.mean) / {p}.std_samp", 4),
        "tf_zscore_pop": treated("({x} - {p}.mean) / {p}.std_pop", 4),
        "tf_outlier_interpolate": over_panel(
            """SELECT p.date, p.stock_ticker, CASE WHEN j.flagged THEN n.stock_price ELSE p.stock_price END AS stock_price
               FROM panel p JOIN judged j ON j.column_name = p.stock_ticker
               JOIN interpolated n ON n.date = p.date AND n.stock_ticker = p.stock_ticker""",
            "long AS (SELECT stock_ticker AS column_name, stock_price AS value FROM panel)",
            bounds(0.02),
            """masked AS (SELECT date, stock_ticker,
                 CASE WHEN j.flagged AND (stock_price < lower OR stock_price > upper) THEN NULL ELSE stock_price END AS stock_price
               FROM panel JOIN judged j ON j.column_name = stock_ticker)""",
            f"interpolated AS ({_interpolate('masked')})",
        ),
        "tf_inverse": over_star(
            """SELECT transaction_id, stock_price, total_trade_amount, round(ln(1 + stock_price), 4) AS stock_price_log,
                 round((total_trade_amount - mean) / deviation, 4) + 0 AS total_trade_amount_zscore
               FROM trades CROSS JOIN (SELECT avg(total_trade_amount) AS mean, stddev_samp(total_trade_amount) AS deviation
                                       FROM trades)"""
        ),
        "tf_imputation_lookup": over_panel(
            """SELECT stock_ticker AS column_name, 'NaN' AS original_value, 'ffill' AS imputed_value,
                 count(f.stock_price) - count(p.stock_price) AS filled_cells
               FROM panel p JOIN filled f USING (date, stock_ticker) GROUP BY 1""",
            FILLED,
        ),
        "tf_encode": over_star(
            f"SELECT transaction_id, stock_liquidity_tier, {encoded('stocks', 'codes', 'NULL')}",
            f"codes AS ({label_rows('stocks', LABELS)})",
        ),
        "tf_decode": over_star(
            f"""SELECT transaction_id, {', '.join(LABELS + FLAGS)}, "timestamp", date, CAST(year(date) AS INT) AS year,
                CAST(month(date) AS INT) AS month, monthname(date) AS month_name, dense_rank() OVER (ORDER BY stock_sector) - 1 AS sector_code
                FROM stocks"""
        ),
        "pipe_app": log_pipeline("panel", "filled_logs"),
        "pipe_dag": log_pipeline("filled", "logs"),
        "pipe_m1": inference(
            f"""SELECT {_FACT_OF_PIPELINE.format(size="greatest(least(average_trade_size, upper), lower)", price="f.stock_price")}
               FROM stocks s LEFT JOIN interpolated f ON f.date = s.date AND f.stock_ticker = s.stock_industry CROSS JOIN caps""",
            f"interpolated AS ({_interpolate('inferred')})",
            """caps AS (SELECT q1 - 0.3 * (q3 - q1) AS lower, q3 + 0.3 * (q3 - q1) AS upper
                        FROM (SELECT quantile_cont(average_trade_size, 0.25) AS q1, quantile_cont(average_trade_size, 0.75) AS q3
                              FROM trades))""",
        ),
        # streaming
        "st_produce": over_star(
            """SELECT FALSE AS is_end, transaction_id, strftime("timestamp", '%Y-%m-%d %H:%M:%S') AS "timestamp", quantity FROM arriving
               UNION ALL SELECT TRUE, NULL, NULL, NULL""",
            SPLIT,
        ),
        "st_source": over_star(
            "SELECT FALSE AS broken, transaction_id, customer_id, quantity, stock_ticker, is_weekend FROM arriving", SPLIT
        ),
        "st_eos": "SELECT event_type, count(*) AS messages FROM events WHERE event_type <> 'error' GROUP BY 1",
        "st_encode": over_star(
            f"SELECT transaction_id, quantity, stock_price, {encoded('arriving', 'codes', '-1')}",
            SPLIT,
            f"codes AS ({label_rows('main', LABELS)})",
        ),
        "st_bad_record": """SELECT CASE event_type WHEN 'click' THEN 0 WHEN 'error' THEN NULL WHEN 'purchase' THEN 2 WHEN 'signup' THEN 3 ELSE -1 END AS code,
            count(*) AS records FROM events GROUP BY 1
            UNION ALL SELECT -100, count(*) FROM events WHERE event_type = 'view'""",
        "st_append": over_star(
            f"""SELECT stock_ticker, transaction_type, count(*) AS trades, {volume()} AS quantity
                FROM (SELECT quantity, {encoded('stocks', 'codes', '-1')}) GROUP BY 1, 2""",
            SPLIT,
            f"codes AS ({label_rows('main', LABELS)})",
        ),
        "st_final_table": over_star(
            f"SELECT transaction_id, transaction_type, stock_sector, quantity FROM (SELECT transaction_id, quantity, {encoded('stocks', 'codes', '-1')})",
            SPLIT,
            f"codes AS ({label_rows('main', LABELS)})",
        ),
        "st_monitor": "SELECT date_trunc('hour', ts) AS hour, event_type, count(*) AS trades FROM events GROUP BY 1, 2",
    }
    sql["snk_summary_json"] = sql["agg_summary"]
    return sql
