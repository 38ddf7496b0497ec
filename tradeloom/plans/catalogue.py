"""Every query by name: a function of (spark, sf_dir) that returns a frame."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeloom import schemas
from tradeloom.functions.columns import holiday_label, year_month
from tradeloom.operators import encode, filters, integrate, portfolio, prices, quality, split, transforms
from tradeloom.plans import pipelines, questions, rollups, star, templates
from tradeloom.sources import files, scratch, sinks
from tradeloom.sources.lookups import Lookups
from tradeloom.streaming import jobs, messages
from tradeloom.streaming.appends import AppendTable

Query = Callable[[SparkSession, str], DataFrame]

NUMBERS = ["quantity", "stock_price", "total_trade_amount", "average_trade_size"]


def _over_fact(query: Callable[..., DataFrame], **options) -> Query:
    """A query over the fact, given only the columns it reads."""
    return lambda spark, sf: query(star.fact(spark, sf, *query.reads), **options)


def _over_view(name: str, **values: str) -> Query:
    return lambda spark, sf: templates.run_template(
        name, star.fact(spark, sf, *templates.TEMPLATE_READS[name]), **values
    )


# --- sources and sinks ---------------------------------------------------------

_CSV_COLUMNS = ["transaction_id", "timestamp", "customer_id", "stock_ticker", "transaction_type", "quantity", "average_trade_size"]


def src_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch.fresh_path(spark, "trades") + ".csv"
    sinks.save(star.fact(spark, sf, *_CSV_COLUMNS), path, "csv")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.TRADES_CSV.fields[:7])
    return files.read_csv(spark, path, schema)


def src_star(spark: SparkSession, sf: str) -> DataFrame:
    """Write the five star tables as CSV, load them typed: every row of each, as text."""
    folder = scratch.fresh_path(spark, "star")
    spark_trades = star.fact(spark, sf, *_CSV_COLUMNS).withColumn(
        "cumulative_portfolio_value", F.lit(None).cast("double")
    )
    days = star.calendar(spark, sf)
    tables = {
        "trades": spark_trades,
        "dim_customer": star.customers(spark, sf).select(
            F.col("customer_id").alias("customer_key"), "customer_id", "account_type"
        ),
        "dim_stock": star.read(spark, sf, "part").select(
            F.col("p_partkey").cast("int").alias("stock_key"),
            star.ticker("p_partkey").alias("stock_ticker"),
            F.col("p_name").alias("company_name"),
            star.liquidity_tier().alias("liquidity_tier"),
            F.col("p_type").alias("sector"),
            F.col("p_brand").alias("industry"),
        ),
        "dim_date": star.read(spark, sf, "orders")
        .select(F.to_date("o_orderdate").alias("date"))
        .distinct()
        .join(F.broadcast(days), "date")
        .select(
            F.date_format("date", "yyyyMMdd").cast("int").alias("date_key"),
            "date",
            F.dayofmonth("date").alias("day"),
            F.month("date").alias("month"),
            F.date_format("date", "MMMM").alias("month_name"),
            F.quarter("date").alias("quarter"),
            F.year("date").alias("year"),
            (F.weekday("date") + 1).alias("day_of_week"),
            "day_name",
            "is_weekend",
            "is_holiday",
        ),
        "daily_trade_prices": star.price_panel(spark, sf),
    }
    for name, table in tables.items():
        sinks.save(table, f"{folder}/{name}.csv", "csv")
    loaded = files.load_star(spark, folder, star.brands(spark, sf))
    rows = [loaded[name].select(F.lit(name).alias("table_name"), _as_text(loaded[name])) for name in tables]
    return reduce(DataFrame.unionByName, rows)


def _as_text(frame: DataFrame) -> Column:
    """A row's values in the order of the columns: numbers with 4 digits, times to the second."""
    texts = []
    for f in frame.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DoubleType):
            c = c.cast("decimal(18,4)")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        texts.append(F.coalesce(c.cast("string"), F.lit("null")))
    return F.concat_ws("|", *texts).alias("row_text")


def src_csv_infer(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch.fresh_path(spark, "inferred") + ".csv"
    columns = ["transaction_id", "customer_id", "quantity", "stock_price", "transaction_type"]
    sinks.save(star.fact(spark, sf, *columns), path, "csv")
    return files.read_csv_inferred(spark, path)


def src_frame_to_spark(spark: SparkSession, sf: str) -> DataFrame:
    """The encoded file straight into Spark and decoded there, the code beside the value."""
    path = scratch.fresh_path(spark, "encoded") + ".csv"
    fact = star.fact(spark, sf, "transaction_id", "transaction_type", "stock_sector", "is_holiday")
    lookups = encode.fit_lookups(fact)
    sinks.save(encode.encode(fact, lookups), path, "csv")
    schema = "transaction_id string, transaction_type bigint, stock_sector bigint, is_holiday int"
    loaded = files.read_csv(spark, path, schema).withColumn("sector_code", F.col("stock_sector"))
    return encode.decode(loaded, lookups)


def src_view(spark: SparkSession, sf: str) -> DataFrame:
    files.register(star.fact(spark, sf, "stock_sector", "quantity"), "stocks")
    return spark.sql("select stock_sector, sum(quantity) as volume, count(*) as n from stocks group by 1")


def src_preview(spark: SparkSession, sf: str) -> DataFrame:
    return files.preview(star.fact(spark, sf), "transaction_id", 10)


def src_fallback(spark: SparkSession, sf: str) -> DataFrame:
    """No decoded table, no encoded table: the fact is read from the base table."""
    folder = scratch.fresh_path(spark, "missing")
    return files.first_available(
        [
            lambda: spark.read.parquet(f"{folder}/decoded"),
            lambda: spark.table("encoded_stock_trades_not_there"),
            lambda: star.fact(spark, sf, "transaction_id", "stock_ticker", "quantity"),
        ]
    )


def _query_logs(spark: SparkSession, sf: str) -> DataFrame:
    """A query log written as JSON from the events: each event is one question."""
    path = scratch.fresh_path(spark, "logs")
    events = star.read(spark, sf, "events")
    failed = F.col("event_type") == "error"
    log = events.select(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        F.concat(F.lit("question "), F.col("event_id").cast("string")).alias("user_query"),
        F.when(~failed, F.col("props")).alias("generated_sql"),
        F.lit("rules").alias("model"),
        F.col("value").alias("execution_time_ms"),
        F.when(failed, "failed").otherwise("success").alias("status"),
        F.when(failed, F.col("props")).alias("error"),
    )
    sinks.save(log, path, "json")
    return files.read_query_logs(spark, path)


def src_json_logs(spark: SparkSession, sf: str) -> DataFrame:
    latest = files.latest_logs(_query_logs(spark, sf), 10)
    return latest.select("timestamp", "user_query", "generated_sql", "execution_time_ms", "status", "error")


def agg_querylog_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(rollups.query_log_metrics(_query_logs(spark, sf)), "avg_execution_time", digits=6)


def _saved(format: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        path = scratch.fresh_path(spark, f"saved-{format}")
        result = questions.volume_by_ticker(star.fact(spark, sf, "stock_ticker", "quantity"))
        sinks.save(result, path, format)
        reader = spark.read.schema(result.schema)
        return (reader.option("header", True) if format == "csv" else reader).format(format).load(path)

    return run


def snk_result(spark: SparkSession, sf: str) -> DataFrame:
    """A result written to files and to a table, and an empty one that keeps its columns, read back."""
    result = questions.price_by_sector(star.fact(spark, sf, "stock_sector", "stock_price"))
    parts = []
    for label, frame in (("whole", result), ("empty", result.filter("stock_sector = 'no such sector'"))):
        path = scratch.fresh_path(spark, f"result-{label}")
        table = path.rpartition("/")[2].replace("-", "_")
        sinks.save_result(frame, path, table)
        files_read = spark.read.schema(result.schema).option("header", True).csv(path)
        parts += [files_read.withColumn("place", F.lit("files")), spark.table(table).withColumn("place", F.lit("table"))]
    return reduce(DataFrame.unionByName, parts)


def snk_csv_sample(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch.fresh_path(spark, "sample")
    fact = star.fact(spark, sf, "transaction_id", "customer_id", "quantity", "total_trade_amount")
    sinks.save_sample(fact, path, "transaction_id", 10)
    return spark.read.schema(fact.schema).option("header", True).csv(path)


def snk_csv_full(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch.fresh_path(spark, "full")
    fact = star.fact(spark, sf, "transaction_id", "customer_id", "stock_sector", "quantity", "total_trade_amount")
    sinks.save(fact, path, "csv")
    return spark.read.schema(fact.schema).option("header", True).csv(path)


def snk_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Lookups written per column and read back as the combined table."""
    written = encode.fit_lookups(star.fact(spark, sf, *schemas.LABEL_COLUMNS, *schemas.FLAG_COLUMNS))
    return Lookups(spark, written.path).all()


def src_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """One column of written lookups."""
    written = encode.fit_lookups(star.fact(spark, sf, "stock_sector", "transaction_type"))
    return Lookups(spark, written.path).of("stock_sector")


def snk_summary_json(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch.fresh_path(spark, "summary")
    result = rollups.summary(star.fact(spark, sf, *rollups.summary.reads))
    sinks.save_summary(result, path)
    return files.read_summary(spark, path, result.schema)


def snk_query_result(spark: SparkSession, sf: str) -> DataFrame:
    files.register(star.fact(spark, sf, "stock_industry", "quantity"), "stocks")
    text = "select stock_industry, sum(quantity) as volume from stocks group by stock_industry"
    path = sinks.save_query(spark, text, scratch.fresh_path(spark, "queries"))
    return spark.read.schema("stock_industry string, volume bigint").option("header", True).csv(path)


def src_table_info(spark: SparkSession, sf: str) -> DataFrame:
    files.register(star.read(spark, sf, "lineitem"), "lineitem_info")
    return files.table_info(spark, "lineitem_info")


# --- projections and filters ---------------------------------------------------


def prj_base(spark: SparkSession, sf: str) -> DataFrame:
    return integrate.base_trades(star.trades(spark, sf))


def prj_dims(spark: SparkSession, sf: str) -> DataFrame:
    return star.stocks(spark, sf).select("stock_ticker", "liquidity_tier", "sector", "industry")


def prj_amount(spark: SparkSession, sf: str) -> DataFrame:
    return integrate.with_amount(
        star.fact(spark, sf, "transaction_id", "stock_price", "quantity")
    ).select("transaction_id", "total_trade_amount")


def prj_rename(spark: SparkSession, sf: str) -> DataFrame:
    joined = integrate.with_stocks(star.fact(spark, sf, "transaction_id", "stock_ticker"), star.stocks(spark, sf))
    return integrate.name_columns(joined)


def prj_drop(spark: SparkSession, sf: str) -> DataFrame:
    leftovers = star.trades(spark, sf).select("transaction_id", "quantity", "date", F.col("date").alias("date_x"))
    return integrate.drop_leftovers(leftovers)


def prj_exp_price(spark: SparkSession, sf: str) -> DataFrame:
    logged = star.fact(spark, sf, "transaction_id", "stock_price").withColumn("stock_price", F.log1p("stock_price"))
    return logged.select("transaction_id", F.round(F.expm1("stock_price"), 4).alias("stock_price_original"))


def prj_case_holiday(spark: SparkSession, sf: str) -> DataFrame:
    fact = star.fact(spark, sf, "transaction_id", "is_holiday")
    return fact.select("transaction_id", holiday_label("is_holiday").alias("period_type"))


def prj_day_name_ts(spark: SparkSession, sf: str) -> DataFrame:
    fact = star.fact(spark, sf, "transaction_id", "timestamp")
    return fact.select("transaction_id", F.date_format("timestamp", "EEEE").alias("day_of_week"))


def _rows(*columns: str, **chosen) -> Query:
    """The ids and the filtered columns of the rows a filter keeps."""
    return lambda spark, sf: filters.choose(star.fact(spark, sf, "transaction_id", *columns), **chosen)


def flt_weekend(spark: SparkSession, sf: str) -> DataFrame:
    return star.fact(spark, sf, "transaction_id", "is_weekend").filter("is_weekend").select("transaction_id")


def flt_all(spark: SparkSession, sf: str) -> DataFrame:
    """All dashboard filters at once, then the KPIs."""
    columns = {"timestamp", "stock_sector", "customer_account_type", "transaction_type", *rollups.kpis.reads}
    fact = filters.choose(
        star.fact(spark, sf, *sorted(columns)),
        days=("1996-01-01", "1999-06-30"),
        tickers=["All"],
        sectors=["PROMO", "LARGE"],
        account_type="BUILDING",
        transaction_type="BUY",
    )
    return rollups.kpis(fact)


def flt_having(spark: SparkSession, sf: str) -> DataFrame:
    return questions.active_customers(star.fact(spark, sf, "customer_id"), more_than=40)


def flt_not_null(spark: SparkSession, sf: str) -> DataFrame:
    """Known sectors only, over a fact whose SMALL sector is unknown."""
    fact = star.fact(spark, sf, "stock_sector", "quantity")
    unknown = fact.withColumn("stock_sector", F.nullif("stock_sector", F.lit("SMALL")))
    return unknown.filter("stock_sector is not null").groupBy("stock_sector").agg(
        F.sum("quantity").alias("total_volume")
    )


def flt_negative(spark: SparkSession, sf: str) -> DataFrame:
    customer = star.read(spark, sf, "customer")
    return quality.negative_counts(customer, ["c_custkey", "c_acctbal"])


def flt_invalid_date(spark: SparkSession, sf: str) -> DataFrame:
    """Event times as text, where errors carry their properties instead."""
    text = F.when(F.col("event_type") == "error", F.col("props")).otherwise(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    )
    return quality.invalid_dates(star.read(spark, sf, "events").select(text.alias("seen_at")), "seen_at")


def flt_key_mismatch(spark: SparkSession, sf: str) -> DataFrame:
    orders = star.read(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return quality.key_mismatch(orders, "o_orderkey", "o_custkey")


def flt_distinct_values(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["stock_ticker", "stock_sector", "customer_account_type", "transaction_type"]
    return filters.distinct_values(star.fact(spark, sf, *columns), columns)


# --- joins ---------------------------------------------------------------------


def _filled_panel(spark: SparkSession, sf: str, method: str = "ffill") -> DataFrame:
    """The filled long panel as a table; it has a row per day and brand."""
    return scratch.materialize(
        prices.fill_prices(prices.melt(star.price_panel(spark, sf)), method), "prices"
    )


def jn_price(spark: SparkSession, sf: str) -> DataFrame:
    quotes = scratch.materialize(prices.melt(star.price_panel(spark, sf)), "prices")
    trades = star.fact(spark, sf, "transaction_id", "timestamp", "stock_industry")
    return integrate.with_prices(trades, quotes, "stock_industry")


def jn_customer(spark: SparkSession, sf: str) -> DataFrame:
    trades = star.fact(spark, sf, "transaction_id", "customer_id")
    return integrate.with_customers(trades, star.customers(spark, sf))


def jn_date(spark: SparkSession, sf: str) -> DataFrame:
    trades = star.fact(spark, sf, "transaction_id", "timestamp")
    return integrate.with_calendar(trades, star.calendar(spark, sf))


def jn_stock(spark: SparkSession, sf: str) -> DataFrame:
    trades = star.fact(spark, sf, "transaction_id", "stock_ticker")
    return integrate.with_stocks(trades, star.stocks(spark, sf))


def jn_integrate(spark: SparkSession, sf: str) -> DataFrame:
    return integrate.integrate(
        star.trades(spark, sf),
        _filled_panel(spark, sf),
        star.customers(spark, sf),
        star.calendar(spark, sf),
        star.stocks(spark, sf),
        price_ticker="stock_industry",
    )


def jn_encode(spark: SparkSession, sf: str) -> DataFrame:
    """Buys coded with lookups fitted on sales of half the sectors, so some are unseen."""
    fact = star.fact(spark, sf, "transaction_id", "stock_sector", "transaction_type")
    seen = fact.filter(F.col("stock_sector").isin("ECONOMY", "LARGE", "PROMO") & (F.col("transaction_type") == "SELL"))
    lookups = encode.fit_lookups(seen)
    return encode.encode(fact, lookups, null_code=encode.UNSEEN)


def jn_decode(spark: SparkSession, sf: str) -> DataFrame:
    """Sector codes 0 to 6 of seven part sizes; 6 has no value and stays."""
    lookups = encode.fit_lookups(star.fact(spark, sf, "stock_sector"))
    coded = star.read(spark, sf, "part").select("p_partkey", (F.col("p_size") % 7).cast("bigint").alias("stock_sector"))
    return encode.decode(coded, lookups)


# --- questions with their own input --------------------------------------------


def q2b_avg_price_onehot(spark: SparkSession, sf: str) -> DataFrame:
    fact = star.fact(spark, sf, "stock_sector", "stock_price")
    flags = [(F.col("stock_sector") == s).cast("int").alias(f"sector_{s}") for s in star.sectors(spark, sf)]
    onehot = fact.select(F.log1p("stock_price").alias("stock_price"), *flags)
    out = questions.price_by_onehot(onehot)
    return out.select(
        "sector",
        F.round("avg_price_original", 4).alias("avg_price_original"),
        F.round("avg_price_logged", 6).alias("avg_price_logged"),
    )


def agg_stock_stats(spark: SparkSession, sf: str) -> DataFrame:
    stats = rollups.stock_stats(star.fact(spark, sf, *rollups.stock_stats.reads))
    stats = _rounded(stats, "stock_price_std", digits=4)
    return _rounded(stats, "stock_price_median", "quantity_median", "total_trade_amount_median")


def an_stock_perf(spark: SparkSession, sf: str) -> DataFrame:
    found = questions.stock_performance(star.fact(spark, sf, *questions.stock_performance.reads))
    return _rounded(found, "price_volatility", digits=4)


def agg_sector_price_stats(spark: SparkSession, sf: str) -> DataFrame:
    found = rollups.sector_price_stats(star.fact(spark, sf, *rollups.sector_price_stats.reads))
    return _rounded(found, "std_price", digits=4)


def agg_heatmap(spark: SparkSession, sf: str) -> DataFrame:
    return rollups.day_sector_heatmap(star.fact(spark, sf, "day_name", "stock_sector"), star.sectors(spark, sf))


def _weekdays_only(query: Callable[..., DataFrame]) -> Query:
    """The fallback branch: the same question over weekdays only."""
    return lambda spark, sf: query(star.fact(spark, sf, *query.reads).filter(~F.col("is_weekend")))


def adhoc_sql(spark: SparkSession, sf: str) -> DataFrame:
    files.register(star.fact(spark, sf, "stock_sector", "stock_liquidity_tier", "quantity"), "stocks")
    return templates.run_sql(
        spark,
        "select stock_sector, stock_liquidity_tier, max(quantity) as largest, count(*) as n from stocks "
        "group by stock_sector, stock_liquidity_tier order by stock_sector, stock_liquidity_tier",
    )


# --- windows -------------------------------------------------------------------


def _fill(method: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return prices.fill_prices(prices.melt(star.price_panel(spark, sf)), method)

    return run


def win_position(spark: SparkSession, sf: str) -> DataFrame:
    trades = star.brand_trades(spark, sf)
    return portfolio.running_position(trades).select("transaction_id", "customer_id", "stock_ticker", "holding")


def win_portfolio_map(spark: SparkSession, sf: str) -> DataFrame:
    """The holdings map, as text so that it compares."""
    held = portfolio.portfolio_map(star.brand_trades(spark, sf), star.brands(spark, sf))
    entries = F.transform(
        F.array_sort(F.map_entries("holdings")), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))
    )
    return held.select("transaction_id", F.array_join(entries, ",").alias("holdings"))


def _panels(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, list[str]]:
    """The panel with its holes, the same filled, and its tickers."""
    brands = star.brands(spark, sf)
    panel = scratch.materialize(star.price_panel(spark, sf, brands), "panel")
    filled = prices.widen(prices.fill_prices(prices.melt(panel, brands)), brands)
    return panel, scratch.materialize(filled, "filled"), brands


def _valued_holdings(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, list[str]]:
    """Holdings of the days with holes, their value at filled prices, panel with its holes, tickers."""
    panel, filled, brands = _panels(spark, sf)
    held = portfolio.held_after(star.brand_trades(spark, sf), brands, portfolio.open_days(panel, brands))
    return scratch.materialize(portfolio.value_holdings(held, filled, brands), "valued"), panel, brands


def jn_holdings_prices(spark: SparkSession, sf: str) -> DataFrame:
    held, panel, brands = _valued_holdings(spark, sf)
    return portfolio.holdings_against_prices(held, panel, brands).select(
        "transaction_id",
        "date",
        "missing_prices",
        F.round("known_value", 4).alias("known_value"),
        F.when(F.col("missing_prices") == 1, F.col("missing_ticker")).alias("missing_ticker"),
        F.when(F.col("missing_prices") == 1, F.col("missing_quantity")).alias("missing_quantity"),
    )


def price_candidates(spark: SparkSession, sf: str) -> DataFrame:
    """What the observed prices alone decide: one price per day and ticker, from the
    first deciding trade."""
    held, panel, brands = _valued_holdings(spark, sf)
    found = portfolio.price_candidates(portfolio.holdings_against_prices(held, panel, brands))
    first = F.struct("customer_id", "timestamp", "transaction_id")
    return found.groupBy("date", F.col("missing_ticker").alias("stock_ticker")).agg(
        F.round(F.min_by("inferred_price", first), 4).alias("inferred_price"),
        F.min_by("transaction_id", first).alias("transaction_id"),
    )


def win_price_inference(spark: SparkSession, sf: str) -> DataFrame:
    """Prices inferred for holes of the panel: (date, stock_ticker, stock_price)."""
    held, panel, brands = _valued_holdings(spark, sf)
    inferred = prices.melt(portfolio.infer_from_held(held, panel, brands), brands)
    known = prices.melt(panel, brands).filter("stock_price is not null").select("date", "stock_ticker")
    new = inferred.filter("stock_price is not null").join(known, ["date", "stock_ticker"], "left_anti")
    return new.withColumn("stock_price", F.round("stock_price", 4))


# --- set operations, split -----------------------------------------------------


def _trade_keys(spark: SparkSession, sf: str) -> DataFrame:
    return star.fact(spark, sf, "transaction_id")


def set_split(spark: SparkSession, sf: str) -> DataFrame:
    return split.mark_stream(_trade_keys(spark, sf))


def set_append(spark: SparkSession, sf: str) -> DataFrame:
    """Sales with their price appended to buys without one."""
    fact = star.fact(spark, sf, "transaction_id", "transaction_type", "quantity", "stock_price")
    old = fact.filter("transaction_type = 'BUY'").drop("stock_price")
    return sinks.append(old, fact.filter("transaction_type = 'SELL'"))


def set_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    """Fully repeated line items: the table with its sales and its first lines once more."""
    lines = star.read(spark, sf, "lineitem")
    copies = lines.filter("l_returnflag = 'R'").unionAll(lines.filter("l_linenumber = 1"))
    return quality.duplicate_rows(lines.unionAll(copies))


def set_distinct(spark: SparkSession, sf: str) -> DataFrame:
    return star.fact(spark, sf, "stock_sector", "transaction_type").distinct()


# --- scalar functions ----------------------------------------------------------


def fn_math(spark: SparkSession, sf: str) -> DataFrame:
    x = F.col("stock_price")
    return star.fact(spark, sf, "transaction_id", "stock_price").select(
        "transaction_id",
        F.round(F.log1p(x), 8).alias("log1p"),
        F.round(F.expm1(F.log1p(x)), 4).alias("restored"),
        F.round(F.exp(x / 10000), 8).alias("exp"),
        F.round(F.log(x + 1), 8).alias("log_offset"),
        F.greatest(F.least(x, F.lit(2000.0)), F.lit(100.0)).alias("clipped"),
    )


def fn_date(spark: SparkSession, sf: str) -> DataFrame:
    events = star.read(spark, sf, "events").select("event_id", F.col("ts").alias("timestamp"))
    parts = encode.with_date_parts(events)
    return parts.select(
        "event_id",
        "date",
        "year",
        "month",
        "month_name",
        year_month("timestamp").alias("year_month"),
        F.date_format("timestamp", "EEEE").alias("day_name"),
        F.date_trunc("hour", "timestamp").cast("timestamp_ntz").alias("hour"),
    )


def fn_json(spark: SparkSession, sf: str) -> DataFrame:
    """Properties parsed by schema and by path, and a row written as JSON and read back."""
    events = star.read(spark, sf, "events")
    again = F.from_json(F.to_json(F.struct("event_id", "event_type", "value")), "event_id bigint, event_type string, value double")
    return events.select(
        "event_id",
        F.from_json("props", "k bigint")["k"].alias("k"),
        F.get_json_object("props", "$.k").cast("bigint").alias("k_by_path"),
        again["event_type"].alias("event_type"),
        again["value"].alias("value"),
    )


def fn_melt(spark: SparkSession, sf: str) -> DataFrame:
    return prices.melt(star.price_panel(spark, sf))


def fn_pivot(spark: SparkSession, sf: str) -> DataFrame:
    brands = star.brands(spark, sf)
    wide = prices.widen(prices.melt(star.price_panel(spark, sf, brands), brands), brands)
    return wide.withColumnsRenamed({b: b.replace("#", "_") for b in brands})


# --- data quality and transforms -----------------------------------------------


def dq_nulls(spark: SparkSession, sf: str) -> DataFrame:
    """Holes of the price panel, per ticker."""
    brands = star.brands(spark, sf)
    return quality.null_counts(star.price_panel(spark, sf, brands), brands)


def _number_fact(spark: SparkSession, sf: str) -> DataFrame:
    return star.fact(spark, sf, *NUMBERS)


def dq_outliers_iqr(spark: SparkSession, sf: str) -> DataFrame:
    found = quality.iqr_outliers(_number_fact(spark, sf), NUMBERS, threshold=0.01)
    return _rounded(found, "q1", "q3", "lower", "upper", "outlier_share")


def dq_outliers_z(spark: SparkSession, sf: str) -> DataFrame:
    return quality.z_outliers(_number_fact(spark, sf), NUMBERS, limit=2.5)


def dq_describe(spark: SparkSession, sf: str) -> DataFrame:
    found = _rounded(quality.describe(_number_fact(spark, sf), NUMBERS), "mean", "std", digits=4)
    return _rounded(found, "q25", "q50", "q75")


def dq_value_counts(spark: SparkSession, sf: str) -> DataFrame:
    return quality.value_counts(star.fact(spark, sf, "quantity"), "quantity")


def dq_profile(spark: SparkSession, sf: str) -> DataFrame:
    """All columns of the fact."""
    # Read three times.
    return quality.profile(scratch.materialize(star.fact(spark, sf), "profiled"))


def dq_reconcile(spark: SparkSession, sf: str) -> DataFrame:
    """The main part, what the stream counted while it was appended, and what the table holds."""
    main, stream = _stream_parts(spark, sf, "transaction_id", "transaction_type")
    table = AppendTable(spark, scratch.fresh_path(spark, "audited"))
    lookups = encode.fit_lookups(main.select("transaction_type"))
    table.append(encode.encode(main, lookups))
    _streamed(spark, stream, lookups, table.path)
    loaded = F.col("stream") == "load"
    sums = table.audit().agg(
        F.sum(F.when(loaded, F.col("stored")).otherwise(0)).alias("rows_before"),
        F.sum(F.when(~loaded, F.col("processed")).otherwise(0)).alias("processed"),
        F.sum("stored").alias("rows_after"),
        F.every("matches").alias("_parts"),
    )
    adds_up = F.col("rows_after") - F.col("rows_before") == F.col("processed")
    return sums.withColumn("matches", F.col("_parts") & adds_up).drop("_parts")


def _rounded(frame: DataFrame, *columns: str, digits: int = 8) -> DataFrame:
    return frame.withColumns({c: F.round(c, digits) for c in columns})


def _treated(method: str, digits: int, threshold: float = 0.01) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        columns = ["stock_price", "total_trade_amount"]
        fact = star.fact(spark, sf, "transaction_id", *columns)
        params = transforms.fit_outliers(fact, columns, method, threshold)
        return _rounded(transforms.apply_outliers(fact, params, columns, method), *columns, digits=digits)

    return run


def tf_outlier_interpolate(spark: SparkSession, sf: str) -> DataFrame:
    """Outliers of the panel replaced along the dates, where a ticker has enough of them."""
    brands = star.brands(spark, sf)
    panel = scratch.materialize(star.price_panel(spark, sf, brands), "panel")
    params = transforms.fit_outliers(panel, brands, "interpolate", threshold=0.02)
    return prices.melt(transforms.apply_outliers(panel, params, brands, "interpolate"), brands)


def tf_inverse(spark: SparkSession, sf: str) -> DataFrame:
    """Log of prices and z-score of amounts, as treated and undone again."""
    fact = star.fact(spark, sf, "transaction_id", "stock_price", "total_trade_amount")
    out, treated = fact, []
    for column, method in (("stock_price", "log"), ("total_trade_amount", "zscore")):
        params = transforms.fit_outliers(fact, [column], method, 0.0)
        between = transforms.apply_outliers(out, params, [column], method).withColumn(f"{column}_{method}", F.col(column))
        out = transforms.undo(between, params, [column], method)
        treated.append(f"{column}_{method}")
    return _rounded(out, "stock_price", "total_trade_amount", *treated, digits=4)


def tf_log_offset(spark: SparkSession, sf: str) -> DataFrame:
    """Logs of account balances, some of which are negative and so moved to 1 and above."""
    balances = star.read(spark, sf, "customer").select("c_custkey", "c_acctbal")
    params = transforms.fit_outliers(balances, ["c_acctbal"], "log_offset", 0.0)
    logged = transforms.apply_outliers(balances, params, ["c_acctbal"], "log_offset")
    return _rounded(logged, "c_acctbal", digits=6)


def tf_imputation_lookup(spark: SparkSession, sf: str) -> DataFrame:
    brands = star.brands(spark, sf)
    panel = scratch.materialize(star.price_panel(spark, sf, brands), "panel")
    filled = prices.widen(prices.fill_prices(prices.melt(panel, brands)), brands)
    return transforms.imputation_lookup(panel, filled, brands, "ffill")


_ENCODED = ["transaction_id", *schemas.LABEL_COLUMNS, *schemas.FLAG_COLUMNS]


def win_label_codes(spark: SparkSession, sf: str) -> DataFrame:
    return encode.fit_labels(star.fact(spark, sf, *schemas.LABEL_COLUMNS), flags=[])


def tf_encode(spark: SparkSession, sf: str) -> DataFrame:
    fact = star.fact(spark, sf, *_ENCODED, "stock_liquidity_tier")
    return encode.encode(fact, encode.fit_lookups(fact.drop("transaction_id")))


def tf_decode(spark: SparkSession, sf: str) -> DataFrame:
    """Encoded, decoded and with date parts: the input again, with the sector's code beside it."""
    # Read twice; written, the rows take less room than the shuffles of their joins.
    fact = scratch.compressed(star.fact(spark, sf, *_ENCODED, "timestamp"), "uncoded")
    lookups = encode.fit_lookups(fact.drop("transaction_id", "timestamp"))
    coded = encode.encode(fact, lookups).withColumn("sector_code", F.col("stock_sector"))
    coded = scratch.compressed(coded, "coded", spent=fact)
    return encode.with_date_parts(encode.decode(coded, lookups))


def _pipeline(order: Callable[[pipelines.Star], DataFrame], with_portfolio: bool = False) -> Query:
    """A cleaning order with gates that these tables pass: without outliers nothing is treated."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        if with_portfolio:
            panel, filled, brands = _panels(spark, sf)
            held = portfolio.held_after(star.brand_trades(spark, sf), brands)
            valued = portfolio.value_holdings(held, filled, brands).drop("_row", "holdings")
            valued = scratch.compressed(valued, "valued", spent=held)
        else:
            valued, brands = None, star.brands(spark, sf)
            panel = scratch.materialize(star.price_panel(spark, sf, brands), "panel")
        out = order(
            pipelines.Star(
                trades=star.trades(spark, sf),
                prices=panel,
                customers=star.customers(spark, sf),
                calendar=star.calendar(spark, sf),
                stocks=star.stocks(spark, sf),
                tickers=brands,
                price_ticker="stock_industry",
                portfolio_trades=valued,
                panel_gate=0.02,
                trade_gate=0.0,
                reach=0.3 if with_portfolio else 1.5,
            )
        )
        treated = [c for c in pipelines.TREATED if c in out.columns]
        return _rounded(out, "average_trade_size", "stock_price", "total_trade_amount", *treated, digits=4)

    return run


# --- streaming -----------------------------------------------------------------

_STREAMED = ["transaction_id", "timestamp", "customer_id", "quantity", "stock_price", *schemas.LABEL_COLUMNS, *schemas.FLAG_COLUMNS]


def _stream_parts(spark: SparkSession, sf: str, *columns: str) -> tuple[DataFrame, DataFrame]:
    """Main part and stream part of the fact, written in one pass. The cut between them is
    located once, on the keys."""
    fact = star.fact(spark, sf, *(columns or _STREAMED))
    return split.write_split(fact, scratch.fresh_path(spark, "split"), keys=_trade_keys(spark, sf))


def st_produce(spark: SparkSession, sf: str) -> DataFrame:
    """The messages as published, end-of-stream included, parsed back by path."""
    _, stream = _stream_parts(spark, sf, "transaction_id", "timestamp", "quantity")
    path = messages.publish_files(stream, scratch.fresh_path(spark, "topic"))
    text = spark.read.text(path)
    end = F.col("value").isin(messages.END_OF_STREAM)
    return text.select(
        end.alias("is_end"),
        F.when(~end, F.get_json_object("value", "$.transaction_id")).alias("transaction_id"),
        F.when(~end, F.get_json_object("value", "$.timestamp")).alias("timestamp"),
        F.when(~end, F.get_json_object("value", "$.quantity").cast("bigint")).alias("quantity"),
    )


def _streamed(spark: SparkSession, stream: DataFrame, lookups: Lookups, table: str) -> None:
    """Publish `stream` and append it, encoded, to `table`."""
    topic = messages.publish_files(stream, scratch.fresh_path(spark, "topic"))
    source = messages.subscribe_files(spark, topic)
    progress, quarantine = scratch.fresh_path(spark, "progress"), scratch.fresh_path(spark, "quarantine")
    jobs.finish([jobs.append_encoded(source, lookups, stream.schema, table, progress, quarantine)])


def _main_lookups(main: DataFrame) -> Lookups:
    return encode.fit_lookups(main.select(*schemas.LABEL_COLUMNS, *schemas.FLAG_COLUMNS))


def st_encode(spark: SparkSession, sf: str) -> DataFrame:
    main, stream = _stream_parts(spark, sf)
    table = scratch.fresh_path(spark, "stream-encoded")
    _streamed(spark, stream, _main_lookups(main), table)
    return jobs.read_appended(spark, table).select(
        "transaction_id", "quantity", "stock_price", *schemas.LABEL_COLUMNS, *schemas.FLAG_COLUMNS
    )


def st_source(spark: SparkSession, sf: str) -> DataFrame:
    """The stream part through source, end-of-stream filter and parser, uncoded."""
    _, stream = _stream_parts(spark, sf, "transaction_id", "customer_id", "quantity", "stock_ticker", "is_weekend")
    topic = messages.publish_files(stream, scratch.fresh_path(spark, "topic"))
    parsed = messages.parse(messages.subscribe_files(spark, topic), stream.schema)
    table = scratch.fresh_path(spark, "received")
    jobs.finish([jobs.drain(parsed.select("broken", "record.*"), table, scratch.fresh_path(spark, "progress"), "parquet")])
    return spark.read.parquet(table).select("broken", "transaction_id", "customer_id", "quantity", "stock_ticker", "is_weekend")


def st_eos(spark: SparkSession, sf: str) -> DataFrame:
    """Events as messages with errors as end-of-stream marks: only the others remain."""
    text = F.when(F.col("event_type") == "error", F.lit('{"message":"EOS"}')).otherwise(
        F.to_json(F.struct("event_id", "event_type"))
    )
    topic = scratch.fresh_path(spark, "topic")
    star.read(spark, sf, "events").select(text.alias("value")).write.text(topic)
    table = scratch.fresh_path(spark, "received")
    received = messages.without_end(messages.subscribe_files(spark, topic))
    jobs.finish([jobs.drain(received, table, scratch.fresh_path(spark, "progress"), "parquet")])
    return spark.read.parquet(table).groupBy(
        F.get_json_object("value", "$.event_type").alias("event_type")
    ).agg(F.count("*").alias("messages"))


def st_bad_record(spark: SparkSession, sf: str) -> DataFrame:
    """Events as messages, errors cut short: those end in the quarantine, the rest is encoded."""
    events = star.read(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("transaction_id"),
        F.col("event_type").alias("transaction_type"),
        F.col("value").alias("stock_price"),
    )
    whole = F.to_json(F.struct("transaction_id", "transaction_type", "stock_price"))
    cut = F.expr("substring(value, 1, length(value) - 5)")
    failed = F.col("transaction_type") == "error"
    topic = scratch.fresh_path(spark, "topic")
    events.withColumn("value", whole).select(F.when(failed, cut).otherwise(F.col("value")).alias("value")).write.text(topic)
    lookups = encode.fit_lookups(events.filter("transaction_type <> 'view'").select("transaction_type"))
    table, quarantine = scratch.fresh_path(spark, "good"), scratch.fresh_path(spark, "bad")
    source, progress = messages.subscribe_files(spark, topic), scratch.fresh_path(spark, "progress")
    jobs.finish([jobs.append_encoded(source, lookups, events.schema, table, progress, quarantine)])
    coded = jobs.read_appended(spark, table)
    good = coded.groupBy(F.col("transaction_type").alias("code")).agg(F.count("*").alias("records"))
    bad = jobs.read_quarantined(spark, table).agg(F.count("*").alias("records")).withColumn("code", F.lit(None).cast("bigint"))
    # The counter kept with the batches, as a code of its own.
    warned = jobs.unseen(spark, table).agg(F.sum("unseen").alias("records")).withColumn("code", F.lit(-100).cast("bigint"))
    return good.unionByName(bad).unionByName(warned)


def st_append(spark: SparkSession, sf: str) -> AppendTable:
    """The table of the encoded main part, to which the stream part is appended."""
    main, stream = _stream_parts(spark, sf)
    table = AppendTable(spark, scratch.fresh_path(spark, "full"))
    lookups = _main_lookups(main)
    table.append(encode.encode(main, lookups))
    _streamed(spark, stream, lookups, table.path)
    return table


def st_append_counts(spark: SparkSession, sf: str) -> DataFrame:
    return st_append(spark, sf).read().groupBy("stock_ticker", "transaction_type").agg(
        F.count("*").alias("trades"), F.sum("quantity").alias("quantity")
    )


def st_final_table(spark: SparkSession, sf: str) -> DataFrame:
    """The committed parts as a table of the catalog under its name, read through it."""
    st_append(spark, sf).register("final_stock_trades")
    return spark.table("final_stock_trades").select("transaction_id", "transaction_type", "stock_sector", "quantity")


def st_monitor(spark: SparkSession, sf: str) -> DataFrame:
    """Events per hour and type, counted as a stream of several batches whose times overlap."""
    events = star.read(spark, sf, "events")
    topic = scratch.fresh_path(spark, "events")
    events.repartition(4, F.hash("event_id")).write.parquet(topic)
    source = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(topic)
    path = scratch.fresh_path(spark, "hours")
    jobs.finish([jobs.count_hours(source, path, scratch.fresh_path(spark, "progress"), "ts", "event_type")])
    hours = jobs.all_counts(spark, path, "event_type")
    return hours.withColumn("hour", F.col("hour").cast("timestamp_ntz"))


def queries() -> dict[str, Query]:
    q, r = questions, rollups
    return {
        # 2.1 sources and sinks
        "src_csv": src_csv,
        "src_star": src_star,
        "src_csv_infer": src_csv_infer,
        "src_frame_to_spark": src_frame_to_spark,
        "src_view": src_view,
        "src_preview": src_preview,
        "src_fallback": src_fallback,
        "src_json_logs": src_json_logs,
        "src_lookup": src_lookup,
        "src_table_info": src_table_info,
        "snk_file_csv": _saved("csv"),
        "snk_file_parquet": _saved("parquet"),
        "snk_file_json": _saved("json"),
        "snk_result": snk_result,
        "snk_csv_sample": snk_csv_sample,
        "snk_csv_full": snk_csv_full,
        "snk_lookup": snk_lookup,
        "snk_summary_json": snk_summary_json,
        "snk_query_result": snk_query_result,
        # 2.2 projections and filters
        "prj_base": prj_base,
        "prj_dims": prj_dims,
        "prj_amount": prj_amount,
        "prj_rename": prj_rename,
        "prj_drop": prj_drop,
        "prj_exp_price": prj_exp_price,
        "prj_case_holiday": prj_case_holiday,
        "prj_day_name_ts": prj_day_name_ts,
        "flt_weekend": flt_weekend,
        "flt_fallback": _weekdays_only(q.weekend_buy_sell_or_all),
        "flt_date_range": _rows("timestamp", days=("1997-01-01", "1997-12-31")),
        "flt_in": _rows("stock_sector", sectors=["PROMO", "SMALL"]),
        "flt_industry": _rows("stock_industry", industries=["Brand#3", "Brand#14"]),
        "flt_eq": _rows("customer_account_type", "transaction_type", account_type="BUILDING", transaction_type="SELL"),
        "flt_all": flt_all,
        "flt_having": flt_having,
        "flt_not_null": flt_not_null,
        "flt_negative": flt_negative,
        "flt_invalid_date": flt_invalid_date,
        "flt_key_mismatch": flt_key_mismatch,
        "flt_ilike": _over_view("sector_like", pattern="%ar%"),
        "flt_const_sector": _over_view("sector_and_industry", sector="PROMO", industry="Brand#7"),
        "flt_distinct_values": flt_distinct_values,
        # 2.3 joins
        "jn_price": jn_price,
        "jn_customer": jn_customer,
        "jn_date": jn_date,
        "jn_stock": jn_stock,
        "jn_integrate": jn_integrate,
        "jn_encode": jn_encode,
        "jn_decode": jn_decode,
        "jn_holdings_prices": jn_holdings_prices,
        # 2.4 questions and analyses
        "q1_volume_by_ticker": _over_fact(q.volume_by_ticker),
        "q2_avg_price_by_sector": _over_fact(q.price_by_sector),
        "q2b_avg_price_onehot": q2b_avg_price_onehot,
        "q3_weekend_buy_sell": _over_fact(q.weekend_buy_sell),
        "q3_weekend_total": _over_fact(q.weekend_total),
        "q3b_weekend_fallback": _over_fact(q.weekend_buy_sell_or_all),
        "q4_active_customers": _over_fact(q.active_customers),
        "q5_amount_by_day": _over_fact(q.amount_by_day),
        "q5b_amount_by_day_ts": _over_fact(q.amount_by_day_of_timestamp),
        "sql_q1_top5": _over_fact(q.sql_top_tickers),
        "sql_q2_avg_by_account": _over_fact(q.sql_average_by_account),
        "sql_q3_holiday": _over_fact(q.sql_holidays_against_rest),
        "sql_q3b_holiday_flag": _over_fact(q.sql_holiday_flag_counts),
        "sql_q4_weekend_sector": _over_fact(q.sql_weekend_sectors),
        "sql_q4b_fallback": _over_fact(q.sql_weekend_sectors_or_all),
        "sql_q4b_fallback_taken": _weekdays_only(q.sql_weekend_sectors_or_all),
        "sql_q5_liquidity_type": _over_fact(q.sql_liquidity_by_type),
        "sql_q5b_liquidity_pivot": _over_fact(q.sql_liquidity_buy_sell),
        "sql_q5c_liquidity_pivot_full": _over_fact(q.sql_liquidity_overview),
        "types_distinct": _over_fact(q.transaction_types),
        "an_stock_perf": an_stock_perf,
        "an_sector": _over_fact(q.sector_analysis),
        "an_customer_type": _over_fact(q.customer_type_analysis),
        "an_temporal": _over_fact(q.temporal_analysis),
        # 2.5 roll-ups and dashboard
        "agg_volume_by_ticker": _over_fact(r.volume_by_ticker),
        "agg_price_by_sector": _over_fact(r.price_by_sector),
        "agg_buy_vs_sell": _over_fact(r.buy_vs_sell),
        "agg_trading_by_day": _over_fact(r.trading_by_day),
        "agg_day_ordered": _over_fact(r.trading_by_day_ordered),
        "agg_customer_distribution": _over_fact(r.customer_distribution),
        "agg_top10_customers": _over_fact(r.top_customers),
        "agg_holiday_comparison": _over_fact(r.holiday_comparison),
        "agg_holiday_stats": _over_fact(r.holiday_stats),
        "agg_sector_comparison": _over_fact(r.sector_comparison),
        "agg_sector_metrics": _over_fact(r.sector_metrics),
        "agg_sector_minmax": _over_fact(r.sector_minmax),
        "agg_liquidity_daily": _over_fact(r.liquidity_daily),
        "agg_liquidity_dist": _over_fact(r.liquidity_distribution),
        "agg_sunburst": _over_fact(r.tier_sector_tree),
        "agg_summary": _over_fact(r.summary),
        "agg_kpi": _over_fact(r.kpis),
        "agg_volume_top_bottom5": _over_fact(r.volume_top_bottom),
        "agg_price_trend": _over_fact(r.price_trend),
        "agg_sector_price_stats": agg_sector_price_stats,
        "agg_type_counts": _over_fact(r.type_counts),
        "agg_customer_hist": _over_fact(r.customer_histogram),
        "agg_recent_hourly": _over_fact(r.recent_hourly),
        "agg_recent_rows": _over_fact(r.recent_rows),
        "agg_monthly_price": _over_fact(r.monthly_price),
        "agg_stock_stats": agg_stock_stats,
        "agg_querylog_metrics": agg_querylog_metrics,
        "agg_weekend_weekday": _over_fact(r.weekend_weekday),
        "agg_avg_trade_size": _over_fact(r.average_trade_size),
        "agg_top_customers_volume": _over_fact(r.top_customers_by_volume),
        "agg_sector_industry_tree": _over_fact(r.sector_industry_tree),
        "agg_heatmap": agg_heatmap,
        # 2.6 templates
        "tpl_tech_volume": _over_view("sector_volume", sector="PROMO"),
        "tpl_ticker_volume_top20": _over_view("ticker_volume_top20"),
        "tpl_sector_avg_price": _over_view("sector_avg_price"),
        "tpl_account_avg_amount": _over_view("account_avg_amount"),
        "tpl_top10_customers": _over_view("top10_customers"),
        "tpl_top10_tickers": _over_view("top10_tickers"),
        "tpl_weekend_types": _over_view("weekend_types"),
        "tpl_holiday_count": _over_view("holiday_count"),
        "tpl_sector_default": _over_view("sector_default"),
        "tpl_sector_volume_top10": _over_view("sector_volume_top10"),
        "tpl_type_by_account": _over_view("type_by_account"),
        "tpl_volume_by_month": _over_view("volume_by_month"),
        "tpl_holiday_rows": _over_view("holiday_rows"),
        "tpl_sector_liquidity": _over_view("sector_liquidity"),
        "tpl_top10_customers_count": _over_view("top10_customers_count"),
        "tpl_weekend_count": _over_view("weekend_count"),
        "tpl_weekend_buys": _over_view("weekend_buys"),
        "adhoc_sql": adhoc_sql,
        # 2.7 windows
        "win_ffill": _fill("ffill"),
        "win_bfill": _fill("bfill"),
        "win_interpolate": _fill("interpolate"),
        "win_position": win_position,
        "win_portfolio_map": win_portfolio_map,
        "win_price_candidates": price_candidates,
        "win_price_inference": win_price_inference,
        "win_label_codes": win_label_codes,
        # 2.9 sets
        "set_append": set_append,
        "set_split": set_split,
        "set_duplicates": set_duplicates,
        "set_distinct": set_distinct,
        # 2.10 scalar functions
        "fn_math": fn_math,
        "fn_date": fn_date,
        "fn_json": fn_json,
        "fn_melt": fn_melt,
        "fn_pivot": fn_pivot,
        # 2.11 quality and transforms
        "dq_nulls": dq_nulls,
        "dq_outliers_iqr": dq_outliers_iqr,
        "dq_outliers_z": dq_outliers_z,
        "dq_describe": dq_describe,
        "dq_value_counts": dq_value_counts,
        "dq_profile": dq_profile,
        "dq_reconcile": dq_reconcile,
        "tf_cap": _treated("cap", 8),
        "tf_log": _treated("log", 6),
        "tf_log_offset": tf_log_offset,
        "tf_zscore": _treated("zscore", 4),
        "tf_zscore_pop": _treated("zscore_pop", 4),
        "tf_outlier_interpolate": tf_outlier_interpolate,
        "tf_inverse": tf_inverse,
        "tf_imputation_lookup": tf_imputation_lookup,
        "tf_encode": tf_encode,
        "tf_decode": tf_decode,
        "pipe_app": _pipeline(pipelines.logs_then_fill),
        "pipe_m1": _pipeline(pipelines.infer_then_cap, with_portfolio=True),
        "pipe_dag": _pipeline(pipelines.fill_then_logs),
        # 2.12 streaming
        "st_produce": st_produce,
        "st_source": st_source,
        "st_eos": st_eos,
        "st_encode": st_encode,
        "st_bad_record": st_bad_record,
        "st_append": st_append_counts,
        "st_final_table": st_final_table,
        "st_monitor": st_monitor,
    }
