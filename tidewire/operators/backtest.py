"""Positions, equity simulation, trades, risk metrics and the report row.

A strategy has one row per day, so its whole history is a short array and the
sequential account is a fold inside one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START_CAPITAL = 10000.0
MIN_PRICE = 0.001
RISK_FREE = 0.02
TRADING_DAYS = 252

_TRADE = "struct<day:int,action:string,price:double,units:double,value:double>"


def positions(signals: DataFrame, calendar: DataFrame) -> DataFrame:
    """Sign of bullish minus bearish signals per (strategy, day); 0 without signals.

    ``signals(strategy_id, day, direction)`` and ``calendar(strategy_id, day)``.
    """
    vote = F.when(F.col("direction") == "bullish", 1).when(F.col("direction") == "bearish", -1).otherwise(0)
    votes = signals.groupBy("strategy_id", "day").agg(F.sum(vote).alias("votes"))
    return calendar.join(votes, ["strategy_id", "day"], "left").select(
        "strategy_id", "day", F.coalesce(F.sign("votes").cast("int"), F.lit(0)).alias("pos")
    )


def simulate(priced: DataFrame) -> DataFrame:
    """Run the account over ``priced(strategy_id, day, pos, act)``.

    Flat and any position: buy with all capital (a short position buys too).
    Holding and no position: sell all. After a purchase at a negative price
    neither rule applies any more.
    """
    state0 = F.struct(
        F.lit(START_CAPITAL).alias("capital"),
        F.lit(0.0).alias("holdings"),
        F.lit(START_CAPITAL).alias("peak"),
        F.lit(0.0).alias("last"),
        F.lit(0).alias("n"),
        F.array().cast(f"array<{_TRADE}>").alias("trades"),
    )

    def trade(s: Column, x: Column, action: str, units: Column, value: Column) -> Column:
        return F.struct(
            s["n"].alias("day"), F.lit(action).alias("action"), x["act"].alias("price"),
            units.cast("double").alias("units"), value.cast("double").alias("value"),
        )

    def step(s: Column, x: Column) -> Column:
        price, none = x["act"], F.lit(None)
        buy = (x["pos"] != 0) & (s["holdings"] == 0)
        sell = (x["pos"] == 0) & (s["holdings"] > 0)
        units = s["capital"] / F.greatest(F.abs(price), F.lit(MIN_PRICE))
        proceeds = s["holdings"] * price
        capital = F.when(buy, F.lit(0.0)).when(sell, proceeds).otherwise(s["capital"])
        holdings = F.when(buy, units).when(sell, F.lit(0.0)).otherwise(s["holdings"])
        worth = F.when(holdings > 0, capital + holdings * price).otherwise(capital)
        added = (
            F.when(buy, F.array(trade(s, x, "buy", units, none)))
            .when(sell, F.array(trade(s, x, "sell", none, proceeds)))
            .otherwise(F.array().cast(f"array<{_TRADE}>"))
        )
        return F.struct(
            capital.alias("capital"), holdings.alias("holdings"),
            F.greatest(s["peak"], worth).alias("peak"), price.alias("last"),
            (s["n"] + 1).alias("n"), F.concat(s["trades"], added).alias("trades"),
        )

    days = F.array_sort(
        F.collect_list(F.struct("day", F.col("pos").cast("int").alias("pos"), F.col("act").cast("double").alias("act")))
    )
    return priced.groupBy("strategy_id").agg(days.alias("days")).select(
        "strategy_id", F.aggregate("days", state0, step).alias("account")
    )


def equity(accounts: DataFrame) -> DataFrame:
    a = "account."
    final = F.col(a + "capital") + F.col(a + "holdings") * F.col(a + "last")
    peak = F.col(a + "peak")
    return accounts.select(
        "strategy_id",
        F.lit(START_CAPITAL).alias("initial_capital"),
        F.round(final, 2).alias("final_value"),
        F.round((final - START_CAPITAL) / START_CAPITAL * 100, 2).alias("total_return_pct"),
        F.size(a + "trades").alias("trade_count"),
        F.round(peak, 2).alias("peak_value"),
        F.when(peak > 0, F.round((peak - final) / peak * 100, 2)).otherwise(F.lit(0.0)).alias("max_drawdown_pct"),
    )


def trades(accounts: DataFrame) -> DataFrame:
    return accounts.select("strategy_id", F.posexplode("account.trades").alias("seq", "t")).select(
        "strategy_id", "seq", "t.*"
    )


def risk_metrics(trade_rows: DataFrame, mode: str = "mixed") -> DataFrame:
    """Sharpe ratio, win rate and average return per strategy.

    ``mixed`` reads a sell's proceeds and a buy's price as one series and calls
    any positive sale a win; ``fixed`` compares each sale with the money put in.
    """
    order = Window.partitionBy("strategy_id").orderBy("seq")
    sold = F.col("value").isNotNull()
    if mode == "mixed":
        level = F.coalesce("value", "price")
        before = F.lag(level).over(order)
        change = F.when((before != 0) & (level != 0), (level - before) / before)
        won = sold & (F.col("value") > 0)
        gain = F.col("value")
    elif mode == "fixed":
        invested = F.lag(F.col("units") * F.abs("price")).over(order)
        change = F.when(sold & (invested != 0), F.col("value") / invested - 1)
        won = sold & (F.col("value") > invested)
        gain = change
    else:
        raise ValueError(f"mode must be 'mixed' or 'fixed', not {mode!r}")
    rows = trade_rows.withColumns({"_change": change, "_won": won, "_gain": F.when(sold, gain)})
    per = rows.groupBy("strategy_id").agg(
        F.count("_change").alias("n"),
        F.avg("_change").alias("mean"),
        F.stddev_pop("_change").alias("spread"),
        F.count_if(F.col("_won")).alias("wins"),
        F.count_if(sold).alias("sales"),
        F.avg("_gain").alias("mean_gain"),
        F.min_by("price", "seq").alias("first_price"),
    )
    sharpe = (
        F.lit(TRADING_DAYS**0.5) * (F.col("mean") - RISK_FREE / TRADING_DAYS) / F.nullif("spread", F.lit(0.0))
    )
    average = F.col("mean_gain") / F.nullif("first_price", F.lit(0.0)) - 1 if mode == "mixed" else F.col("mean_gain")
    return per.select(
        "strategy_id",
        F.when(F.col("n") >= 2, F.coalesce(sharpe, F.lit(0.0))).otherwise(F.lit(0.0)).alias("sharpe_ratio"),
        (F.col("wins") / F.greatest("sales", F.lit(1))).alias("win_rate"),
        F.coalesce(average, F.lit(0.0)).alias("avg_return_per_trade"),
    )


def report(accounts: DataFrame, trends: DataFrame | None = None, mode: str = "mixed") -> DataFrame:
    """One summary row per strategy, also packed as JSON.

    ``trends(strategy_id, trend, horizon_days)`` is optional.
    """
    rows = equity(accounts).join(risk_metrics(trades(accounts), mode), "strategy_id", "left")
    if trends is not None:
        rows = rows.join(trends, "strategy_id", "left")
    else:
        rows = rows.withColumns({"trend": F.lit(None).cast("string"), "horizon_days": F.lit(None).cast("int")})
    rate = F.round(F.coalesce("win_rate", F.lit(0.0)) * 100, 1)
    flat = rows.select(
        F.concat(F.lit("bt_"), F.substring("strategy_id", 1, 8)).alias("report_id"),
        "strategy_id",
        "total_return_pct",
        "max_drawdown_pct",
        "trade_count",
        F.coalesce("sharpe_ratio", F.lit(0.0)).alias("sharpe_ratio"),
        F.format_string("%.1f%%", rate).alias("win_rate"),
        F.coalesce("trend", F.lit("unknown")).alias("trend"),
        F.coalesce("horizon_days", F.lit(0)).alias("horizon"),
    )
    return flat.withColumn("report", F.to_json(F.struct(*flat.columns)))
