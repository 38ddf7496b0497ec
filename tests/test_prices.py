"""Fills and inference against pandas and against a plain loop."""

import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tradeloom.operators import portfolio, prices
from tradeloom.sources import scratch

DAYS = [dt.date(2024, 1, 1) + dt.timedelta(days=d) for d in (0, 1, 2, 5, 6, 7, 12, 13, 20, 21)]
GAPS = {
    "full": [float(i) for i in range(10)],
    "gaps": [None, 2.0, None, None, 5.0, 6.5, None, 8.0, 1.0, None],
    "none": [None] * 10,
    "one": [None, None, None, 4.0, None, None, None, None, None, None],
}


def panel(spark):
    rows = [(d, *[GAPS[t][i] for t in GAPS]) for i, d in enumerate(DAYS)]
    return spark.createDataFrame(rows, "date date, " + ", ".join(f"`{t}` double" for t in GAPS))


@pytest.mark.parametrize("method", ["ffill", "bfill", "interpolate"])
def test_fill_equals_pandas(spark, method):
    frame = pd.DataFrame(GAPS, dtype="float64")
    if method == "ffill":
        want = frame.ffill().bfill()
    elif method == "bfill":
        want = frame.bfill().ffill()
    else:
        want = frame.interpolate(method="linear").bfill().ffill()
    filled = prices.fill_prices(prices.melt(panel(spark)), method)
    got = {(r.stock_ticker, r.date): r.stock_price for r in filled.collect()}
    assert len(got) == 40
    for ticker in GAPS:
        for i, day in enumerate(DAYS):
            expected = want[ticker][i]
            assert got[ticker, day] == (None if pd.isna(expected) else pytest.approx(expected, abs=1e-12))


def test_unknown_fill_method(spark):
    with pytest.raises(ValueError):
        prices.fill_prices(prices.melt(panel(spark)), "nearest")


def test_melt_and_widen_are_inverse(spark):
    wide = panel(spark)
    again = prices.widen(prices.melt(wide), list(GAPS))
    assert sorted(map(tuple, again.collect()), key=str) == sorted(map(tuple, wide.collect()), key=str)


TICKERS = ["A", "B", "C", "D"]


def random_trades(seed, n=400, customers=5):
    """Trades of few customers on few days, many at equal times, sales often beyond zero."""
    rng = random.Random(seed)
    start = dt.datetime(2024, 3, 1)
    return [
        (
            f"t{i:04d}",
            start + dt.timedelta(days=rng.randrange(12)),
            rng.choices(range(customers), weights=[8] + [1] * (customers - 1))[0],
            rng.choice(TICKERS),
            rng.choice(["BUY", "BUY", "SELL"]),
            rng.randrange(1, 20),
        )
        for i in range(n)
    ]


TRADE_TYPE = (
    "transaction_id string, timestamp timestamp_ntz, customer_id bigint, stock_ticker string, "
    "transaction_type string, quantity bigint"
)


def replay(rows):
    """Portfolio of the customer after each trade."""
    state, out = {}, {}
    for r in sorted(rows, key=lambda r: (r[2], r[1], r[0])):
        held = state.setdefault(r[2], {})
        change = r[5] if r[4] == "BUY" else -r[5]
        held[r[3]] = held.get(r[3], 0) + change
        if held[r[3]] <= 0:
            del held[r[3]]
        out[r[0]] = dict(held)
    return out


@pytest.mark.parametrize("slices", [1, 4, 40])
def test_positions_equal_replay(spark, slices):
    """Rows in one slice, some, and many slices of a customer, of one day even."""
    spark.conf.set("spark.sql.shuffle.partitions", str(slices))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        _positions_equal_replay(spark)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def _positions_equal_replay(spark):
    rows = random_trades(1)
    trades = spark.createDataFrame(rows, TRADE_TYPE)
    want = replay(rows)
    position = portfolio.running_position(trades).collect()
    assert len(position) == len(rows)
    assert all(r.holding == want[r.transaction_id].get(r.stock_ticker, 0) for r in position)
    maps = portfolio.portfolio_map(trades, TICKERS).collect()
    assert {r.transaction_id: r.holdings for r in maps} == want


def test_position_edges(spark):
    at = lambda d: dt.datetime(2024, 1, d)
    rows = [
        ("1", at(1), 1, "A", "SELL", 5),  # nothing to sell
        ("2", at(2), 1, "A", "BUY", 5),
        ("3", at(3), 1, "A", "SELL", 5),  # exactly to zero
        ("4", at(4), 1, "A", "BUY", 2),
        ("5", at(5), 1, "A", "SELL", 9),  # beyond zero
        ("6", at(6), 1, "A", "BUY", 3),
        ("7", at(6), None, "A", "BUY", 4),  # unknown customer
    ]
    trades = spark.createDataFrame(rows, TRADE_TYPE)
    got = portfolio.running_position(trades).collect()
    assert {r.transaction_id: r.holding for r in got} == {"1": 0, "2": 5, "3": 0, "4": 2, "5": 0, "6": 3, "7": 4}


def test_a_ticker_outside_the_panel_is_an_error(spark):
    trades = spark.createDataFrame([("1", dt.datetime(2024, 1, 1), 1, "Z", "BUY", 7)], TRADE_TYPE)
    with pytest.raises(Exception, match="without a price column"):
        portfolio.portfolio_map(trades, ["A"]).collect()


def scan(rows, values, table):
    """The inference as a loop over the trades, writing into `table` as it goes."""
    held = replay(rows)
    for r in sorted(rows, key=lambda r: (r[2], r[1], r[0])):
        day, mine = r[1].date(), held[r[0]]
        if not mine or day not in table:
            continue
        missing = [t for t in mine if table[day][t] is None]
        if len(missing) == 1:
            known = sum(table[day][t] * mine[t] for t in mine if t != missing[0])
            price = (values[r[0]] - known) / mine[missing[0]]
            if 0 < price < 10000:
                table[day][missing[0]] = price
    return table


@pytest.mark.parametrize("seed", [3, 4, 5, 6])
def test_inference_equals_scan(spark, seed):
    """Holes decided at once, after another hole, never, out of bounds, without a day.

    The portfolio values are not consistent with any prices, so the first deciding
    trade matters and a wrong order shows.
    """
    rng = random.Random(seed)
    rows = random_trades(seed, n=150, customers=6)
    days = sorted({r[1].date() for r in rows})[:-1]
    observed = {d: {t: (None if rng.random() < 0.45 else round(rng.uniform(1, 50), 2)) for t in TICKERS} for d in days}
    values = {r[0]: rng.uniform(-200, 3000) if rng.random() < 0.9 else 1e7 for r in rows}
    want = scan(rows, values, {d: dict(p) for d, p in observed.items()})

    trades = spark.createDataFrame(
        [(*r, values[r[0]]) for r in rows], TRADE_TYPE + ", cumulative_portfolio_value double"
    )
    wide = spark.createDataFrame(
        [(d, *[observed[d][t] for t in TICKERS]) for d in days], "date date, " + ", ".join(f"{t} double" for t in TICKERS)
    )
    got = {r.date: {t: r[t] for t in TICKERS} for r in portfolio.infer_prices(trades, wide, TICKERS).collect()}
    assert got.keys() == want.keys()
    for d in days:
        for t in TICKERS:
            expected = want[d][t]
            assert got[d][t] == (None if expected is None else pytest.approx(expected, rel=1e-9))
    assert any(observed[d][t] is None and want[d][t] is not None for d in days for t in TICKERS)


def test_nothing_to_infer(spark):
    trades = spark.createDataFrame(
        [("1", dt.datetime(2024, 1, 1), 1, "A", "BUY", 1, 10.0)], TRADE_TYPE + ", cumulative_portfolio_value double"
    )
    wide = spark.createDataFrame([(dt.date(2024, 1, 1), 10.0)], "date date, A double")
    assert [tuple(r) for r in portfolio.infer_prices(trades, wide, ["A"]).collect()] == [(dt.date(2024, 1, 1), 10.0)]
    held = portfolio.held_after(trades.drop("cumulative_portfolio_value"), ["A"])
    assert portfolio.value_holdings(held, wide, ["A"]).first()["cumulative_portfolio_value"] == 10.0
    assert portfolio.holdings_against_prices(held, wide, ["A"]).collect() == []


def test_rounds_read_less_and_less(spark, monkeypatch):
    """Each round's frontier is a part of the one before."""
    sizes = []

    def counted(frame, label):
        out = scratch.materialize(frame, label)
        if label == "frontier":
            sizes.append(out.count())
        return out

    monkeypatch.setattr(portfolio, "materialize", counted)
    rng = random.Random(11)
    rows = random_trades(11, n=300, customers=5)
    days = sorted({r[1].date() for r in rows})
    true = {d: {t: round(rng.uniform(1, 50), 2) for t in TICKERS} for d in days}
    held = replay(rows)
    trades = spark.createDataFrame(
        [(*r, sum((true[r[1].date()][t] * q for t, q in held[r[0]].items()), 0.0)) for r in rows],
        TRADE_TYPE + ", cumulative_portfolio_value double",
    )
    cells = [(d, *[None if rng.random() < 0.6 else true[d][t] for t in TICKERS]) for d in days]
    wide = spark.createDataFrame(cells, "date date, " + ", ".join(f"{t} double" for t in TICKERS))
    found = portfolio.infer_prices(trades, wide, TICKERS).collect()
    assert len(sizes) > 2 and all(a > b for a, b in zip(sizes, sizes[1:]))
    before = sum(c is None for row in cells for c in row)
    after = sum(r[t] is None for r in found for t in TICKERS)
    assert after < before
    for r in found:
        assert all(r[t] is None or r[t] == pytest.approx(true[r.date][t]) for t in TICKERS)


def test_holdings_of_thousands_of_tickers(spark):
    """No column per ticker: 5 000 of them, one customer with a third of all trades."""
    rng = random.Random(2)
    tickers = [f"T{i:04d}" for i in range(5000)]
    start = dt.datetime(2024, 3, 1)
    rows = [
        (f"t{i:05d}", start + dt.timedelta(days=i // 100), rng.choice([0, 0, *range(1, 5)]), rng.choice(tickers),
         rng.choice(["BUY", "BUY", "SELL"]), rng.randrange(1, 20))
        for i in range(3000)
    ]
    want = replay(rows)
    trades = spark.createDataFrame(rows, TRADE_TYPE)
    held = portfolio.held_after(trades, tickers)
    assert {r.transaction_id: r.holdings for r in held.collect()} == want
    day = spark.createDataFrame([(start.date() + dt.timedelta(days=d),) for d in (3, 29)], "_day date")
    some = portfolio.held_after(trades, tickers, day)
    assert {r.transaction_id: r.holdings for r in some.collect()} == {
        r[0]: want[r[0]] for r in rows if (r[1] - start).days in (3, 29)
    }
    assert len(trades.columns) + 2 == len(held.columns)


def test_holdings_of_odd_trades(spark):
    """Unknown customers and tickers, repeated rows, kinds that are neither, more rows than a block."""
    at = dt.datetime(2024, 1, 1)
    rows = [("1", at, None, "A", "BUY", 2), ("2", at, None, None, "BUY", 3), ("3", at, 0, "A", "BUY", 5), ("4", at, 0, "B", "HOLD", 5)]
    rows += [("5", at, 0, "B", "BUY", 1)] * 40 + [("6", None, 0, "A", "BUY", 7)]
    got = sorted((r.transaction_id, sorted(r.holdings.items())) for r in portfolio.portfolio_map(spark.createDataFrame(rows, TRADE_TYPE), ["A", "B"]).collect())
    assert got[:2] == [("1", [("A", 2)]), ("2", [("A", 2)])]
    assert got[2:4] == [("3", [("A", 12)]), ("4", [("A", 12)])]
    assert sorted(dict(h)["B"] for i, h in got if i == "5") == list(range(1, 41))
    assert got[-1] == ("6", [("A", 7)])
    assert portfolio.portfolio_map(spark.createDataFrame([], TRADE_TYPE), ["A"]).collect() == []
