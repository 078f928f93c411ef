import datetime
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewire.operators import backtest, explain, forecast, learn, runs, signals

FEATURES = "event_id string, sentiment_score double, entity_count int, text_length int, sentiment_label string"


@pytest.fixture(scope="module")
def features(spark):
    rng = np.random.default_rng(0)
    rows = []
    for i in range(200):
        s = float(rng.choice([-1.0, 0.0, 1.0]))
        label = {1.0: "positive", -1.0: "negative", 0.0: "neutral"}[s]
        rows.append((str(i), s, int(rng.integers(0, 5)), int(rng.integers(0, 900)), label))
    return spark.createDataFrame(rows, FEATURES)


@pytest.fixture(scope="module")
def trained(features):
    return learn.train_forest(features, trees=5, depth=4)


def test_training(trained, features):
    row = trained[1].first()
    assert row.status == "trained" and row.train_samples + row.test_samples == 200 and row.feature_dim == 3
    assert row.test_accuracy > 0.9
    assert learn.train_forest(features.limit(9))[1].first().status == "skipped"


def test_split_ignores_partitioning(features):
    a = {r.event_id: r.is_train for r in learn.encode_and_split(features).collect()}
    b = {r.event_id: r.is_train for r in learn.encode_and_split(features.repartition(7)).collect()}
    assert a == b and 130 < sum(a.values()) < 185


def test_attribution_is_exact(trained, features, spark):
    model = trained[0]
    base = explain.baseline_of(features)
    rows = features.limit(4)
    got = {}
    for r in explain.attribute(model, rows, base, target_class=1).collect():
        got.setdefault(r.event_id, {})[r.feature] = r
    names = learn.MODEL_FEATURES

    def value(point):
        df = spark.createDataFrame([tuple(float(point[c]) for c in names)], names)
        return float(model.transform(learn.assemble(df)).first().probability[1])

    for r in rows.collect():
        phi = dict.fromkeys(names, 0.0)
        for order in permutations(names):
            point = dict(base)
            before = value(point)
            for c in order:
                point[c] = r[c]
                after = value(point)
                phi[c] += (after - before) / 6
                before = after
        mine = got[r.event_id]
        for c, shown in zip(names, explain.FEATURE_NAMES):
            assert abs(mine[shown].shap_value - phi[c]) < 1e-4
        top = max(explain.FEATURE_NAMES, key=lambda f: abs(mine[f].shap_value))
        assert abs(mine[mine["sentiment"].top_feature].shap_value) == abs(mine[top].shap_value)


def test_attribution_is_the_mean_over_the_background(trained, features):
    model = trained[0]
    points = explain.background_of(features, 3)
    assert len(points) == 3
    rows = features.limit(3)

    def values(background):
        found = explain.attribute(model, rows, background).collect()
        return {(r.event_id, r.feature): (r.shap_value, r.base_value) for r in found}

    single = [values(p) for p in points]
    for key, got in values(points).items():
        for at in (0, 1):
            assert abs(got[at] - sum(s[key][at] for s in single) / 3) < 2e-4


def test_evaluation(spark):
    pairs = [(0, 0), (0, 1), (1, 1), (1, 1), (2, 0), (2, 1)]
    df = spark.createDataFrame(pairs, "label int, pred int")
    rows = {r.name: r for r in learn.evaluate(df).collect()}
    assert (rows["0"].precision, rows["0"].recall, rows["0"].f1, rows["0"].support) == (0.5, 0.5, 0.5, 2)
    assert (rows["2"].precision, rows["2"].recall, rows["2"].f1) == (0.0, 0.0, 0.0)
    assert np.isclose(rows["1"].f1, 2 * 0.5 * 1 / 1.5)
    assert np.isclose(rows["macro avg"].precision, (0.5 + 0.5 + 0) / 3)
    assert np.isclose(rows["weighted avg"].recall, 0.5) and rows["macro avg"].accuracy == 0.5
    assert learn.evaluate(df.limit(4)).count() == 0 and learn.evaluate(df.limit(5)).count() > 0
    table = {(r.label, r.pred): r.n for r in learn.confusion(df).collect()}
    assert table == {(0, 0): 1, (0, 1): 1, (0, 2): 0, (1, 0): 0, (1, 1): 2, (1, 2): 0, (2, 0): 1, (2, 1): 1, (2, 2): 0}


def test_confusion_holds_every_class_seen(spark):
    df = spark.createDataFrame([(0, 0), (0, 3), (1, 2)], "label int, pred int")
    table = {(r.label, r.pred): r.n for r in learn.confusion(df).collect()}
    assert len(table) == 16 and sum(table.values()) == 3 and table[(0, 3)] == table[(1, 2)] == 1 and table[(2, 2)] == 0


def test_registry(trained, spark, tmp_path):
    root = str(tmp_path)
    a = learn.register_model(trained[0], root, {"acc": 1.0}, {"trees": 5}, "2024-01-01")
    b = learn.register_model(trained[0], root, {"acc": 0.5}, {}, "2024-01-02")
    assert [r.model_id for r in learn.list_models(spark, root).collect()] == [a, b]
    assert learn.get_model(spark, root, b).first().registered_at == "2024-01-02"


SIGNALS = "signals array<struct<type:string,severity:string,direction:string,confidence:double,reason:string>>"


def test_drift(spark):
    bear = ("r", "high", "bearish", 0.9, "because")
    rows = [("g", -0.6, [bear] * 3), ("h", 0.0, [("o", "high", "bullish", None, "x")])]
    df = spark.createDataFrame(rows, f"g string, avg_sentiment double, {SIGNALS}")
    out = forecast.drift_forecast(df, "g", run_date="2024-02-28")
    first = out.filter("g = 'g' and day = 1").first()
    assert (first.date, first.trend) == ("2024-02-29", "bearish")
    assert np.isclose(first.predicted_sentiment, round(-0.6 - 0.0135, 4)) and np.isclose(first.confidence, 0.635)
    assert np.isclose(first.upper_bound - first.lower_bound, 0.2)
    last = out.filter("g = 'g' and day = 30").first()
    assert last.end == last.predicted_sentiment and np.isclose(last.change, last.end + 0.6)
    assert np.isclose(out.filter("g = 'h' and day = 1").first().predicted_sentiment, 0.0025)
    assert out.count() == 60


def test_series_models(spark):
    rows = [("one", 0, 2.0)] + [("two", 0, 1.0), ("two", 1, 3.0)] + [("many", i, float(i * i)) for i in range(30)]
    df = spark.createDataFrame(rows, "series_id string, idx int, value double")
    line = {(r.series_id, r.step): r.value for r in forecast.linear_forecast(df).collect()}
    slope = np.polyfit(range(30), [i * i for i in range(30)], 1)[0]
    assert line["one", 30] == 2.0 and line["two", 2] == 7.0 and np.isclose(line["many", 10], 29 * 29 + 10 * slope)
    growth = {(r.series_id, r.step): r.value for r in forecast.growth_forecast(df).collect()}
    assert growth["two", 1] == 3.0 and np.isclose(growth["two", 30], 3 * 1.029)


def test_ensemble_weights_by_position(spark):
    rows = [("a", "linear", i, 1.0) for i in (1, 2, 3)] + [("a", "drift", i, 4.0) for i in (1, 2)]
    rows += [("b", m, 1, v) for m, v in (("drift", 3.0), ("growth", 2.0), ("linear", 1.0))]
    out = forecast.ensemble(spark.createDataFrame(rows, "series_id string, model string, step int, value double"))
    got = {(r.series_id, r.step): (round(r.value, 6), r.models_used) for r in out.collect()}
    assert got == {
        ("a", 1): (round((0.5 + 0.3 * 4) / 0.8, 6), 2), ("a", 2): (round((0.5 + 0.3 * 4) / 0.8, 6), 2), ("b", 1): (1.7, 3)
    }


def test_ensemble_knows_its_models(spark):
    rows = [("a", m, 1, v) for m, v in (("linear", 1.0), ("growth", 2.0), ("other", 100.0))]
    df = spark.createDataFrame(rows, "series_id string, model string, step int, value double")
    with pytest.raises(Exception, match="no weight for forecast model other"):
        forecast.ensemble(df).collect()
    named = forecast.ensemble(df, (0.5, 0.3, 0.2), ("linear", "growth", "other")).first()
    assert named.models_used == 3 and round(named.value, 6) == 21.1


def plain_account(days):
    cash, held, peak, out = 10000.0, 0.0, 10000.0, []
    for pos, price in days:
        if pos and held == 0:
            held, cash = cash / max(abs(price), 0.001), 0.0
            out.append(("buy", price))
        elif not pos and held > 0:
            cash, held = held * price, 0.0
            out.append(("sell", price))
        peak = max(peak, cash + held * price if held > 0 else cash)
    final = cash + held * days[-1][1]
    return round(final, 2), round(peak, 2), round((peak - final) / peak * 100, 2), out


ACCOUNTS = {
    "plain": [(1, 10.0), (1, 12.0), (0, 11.0), (-1, 10.0), (0, 15.0), (0, 9.0)],
    "negative": [(1, -2.0), (0, 5.0), (1, 3.0)],
    "zero": [(1, 0.0), (0, 4.0)],
    "flat": [(0, 1.0), (0, 2.0)],
    "open": [(1, 4.0), (1, 8.0)],
}


@pytest.fixture(scope="module")
def accounts(spark):
    rows = [
        (name, datetime.date(2024, 1, 1 + i), pos, act) for name, days in ACCOUNTS.items() for i, (pos, act) in enumerate(days)
    ]
    return backtest.simulate(spark.createDataFrame(rows, "strategy_id string, day date, pos int, act double").repartition(3))


def test_equity_and_trades(accounts):
    rows = {r.strategy_id: r for r in backtest.equity(accounts).collect()}
    for name, days in ACCOUNTS.items():
        final, peak, drawdown, log = plain_account(days)
        r = rows[name]
        assert (r.final_value, r.peak_value, r.max_drawdown_pct, r.trade_count) == (final, peak, drawdown, len(log))
        got = backtest.trades(accounts).filter(F.col("strategy_id") == name).orderBy("seq").collect()
        assert [(t.action, t.price) for t in got] == log
    assert rows["plain"].total_return_pct == 65.0


def test_metrics(accounts):
    rows = {r.strategy_id: r for r in backtest.risk_metrics(backtest.trades(accounts)).collect()}
    levels = [10.0, 11000.0, 10.0, 16500.0]
    changes = np.diff(levels) / levels[:-1]
    r = rows["plain"]
    assert np.isclose(r.sharpe_ratio, np.sqrt(252) * (changes.mean() - 0.02 / 252) / changes.std())
    assert r.win_rate == 1.0 and np.isclose(r.avg_return_per_trade, np.mean([11000.0, 16500.0]) / 10.0 - 1)
    assert (rows["open"].sharpe_ratio, rows["open"].win_rate, rows["open"].avg_return_per_trade) == (0.0, 0.0, 0.0)
    fixed = {r.strategy_id: r for r in backtest.risk_metrics(backtest.trades(accounts), "fixed").collect()}
    gains = np.array([0.1, 0.5])
    assert np.isclose(fixed["plain"].avg_return_per_trade, 0.3)
    assert np.isclose(fixed["plain"].sharpe_ratio, np.sqrt(252) * (gains.mean() - 0.02 / 252) / gains.std())


def test_positions_and_report(accounts, spark):
    day = datetime.date(2024, 1, 1)
    fired = spark.createDataFrame(
        [("s", day, "bullish"), ("s", day, "bullish"), ("s", day, "bearish"), ("t", day, "bearish"), ("t", day, "neutral")],
        "strategy_id string, day date, direction string",
    )
    calendar = spark.createDataFrame([("s", day), ("t", day), ("u", day)], "strategy_id string, day date")
    assert {r.strategy_id: r.pos for r in backtest.positions(fired, calendar).collect()} == {"s": 1, "t": -1, "u": 0}
    row = backtest.report(accounts).filter("strategy_id = 'plain'").first()
    assert (row.report_id, row.win_rate, row.trend, row.horizon) == ("bt_plain", "100.0%", "unknown", 0)
    assert '"trade_count":4' in row.report


def test_explanation(spark):
    bear = ("market_risk", "high", "bearish", 0.95, "Strong negative sentiment (-0.95)")
    df = spark.createDataFrame(
        [("g", -0.9, [bear] * 3), ("h", 0.0, [])], f"g string, avg_sentiment double, {SIGNALS}"
    )
    paths = spark.createDataFrame([("g", 2)], "g string, causal_paths int")
    shap = spark.createDataFrame(
        [("g", "sentiment", -0.4), ("g", "text_length", 0.1), ("g", "entity_count", 0.4)], "g string, feature string, shap_value double"
    )
    rows = {r.g: r for r in explain.explain(df, "g", "now", paths=paths, attributions=shap).collect()}
    assert rows["g"].summary == (
        "The bearish prediction is primarily driven by sentiment (SHAP value: -0.400). This pattern resembles the "
        "2008 Financial Crisis event (similarity: 1.00). Key signal: Strong negative sentiment (-0.95). "
        "2 causal paths identified in the knowledge graph."
    )
    assert rows["g"].recommendation == explain.HEDGE and len(rows["g"].active_signals) == 3
    assert rows["g"].key_factors == explain.FEATURE_NAMES
    assert "driven by unknown (SHAP value: 0.000)" in rows["h"].summary
    assert "No strong signals" in rows["h"].summary and rows["h"].recommendation == explain.HOLD


def test_runs(spark):
    t0 = datetime.datetime(2024, 1, 1)
    rows = [
        (str(i), "p", s, t0 + datetime.timedelta(hours=i), t0 + datetime.timedelta(hours=i, seconds=2), None)
        for i, s in enumerate(["success", "failed", "cancelled", "success"])
    ]
    log = spark.createDataFrame(
        rows, "run_id string, pipeline string, status string, started_at timestamp_ntz, completed_at timestamp_ntz, error string"
    )
    timed = runs.with_duration(log)
    row = runs.summary(timed).first()
    assert (row.total_runs, row.successful, row.failed, row.success_rate, row.avg_duration_ms) == (4, 3, 1, 75.0, 2000.0)
    assert runs.summary(timed.filter("false")).first().success_rate == 0.0
    assert [r.run_id for r in runs.recent(log, 2).collect()] == ["3", "2"]
    assert runs.failures(log).first().run_id == "1"


def test_signal_count_bounds_group_arrays(spark):
    df = spark.createDataFrame([("x", -0.9, 0.0, 0.9, 9.0, 0.9)],
                               "g string, avg_sentiment double, positive_ratio double, negative_ratio double, "
                               "avg_entity_count double, geo_ratio double")
    assert len(signals.with_signals(df).first().signals) == 3
