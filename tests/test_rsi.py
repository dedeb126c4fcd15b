import datetime
import random

import pytest

from eodlake.operators import rsi as R

DAY = datetime.date(2000, 1, 3)
SCHEMA = "isin string, exchange string, trade_date date, close double, prev_close double, series string, symbol string, tot_trd_qty long"


def walk(rows, gap):
    """The recurrence as it is written down, for one instrument: {day: (avg_gain, avg_loss)}."""
    out, last, seen, avg = {}, None, [], None
    for d, close, prev in rows:
        if close is None or prev is None:
            out[d] = None
            continue
        if last is not None and (d - last).days - 1 >= gap:
            seen, avg = [], None
        last = d
        x = (max(close - prev, 0.0), max(prev - close, 0.0))
        seen.append(x)
        if len(seen) == 14:
            avg = tuple(sum(s[k] for s in seen) / 14 for k in (0, 1))
        elif len(seen) > 14:
            avg = tuple((avg[k] * 13 + x[k]) / 14 for k in (0, 1))
        out[d] = avg
    return out


def panel(spark, days, seed=1, n=1):
    r, data = random.Random(seed), []
    for i in range(n):
        prev = 100.0
        for k in days:
            close = round(prev * (1 + r.uniform(-0.05, 0.05)), 2)
            data.append((f"I{i}", "NSE", DAY + datetime.timedelta(k), close, prev, "N", "s", 1))
            prev = min(max(close, 20.0), 500.0)
    return data, spark.createDataFrame(data, SCHEMA)


def calendar(spark, n):
    return R.sessions(spark.createDataFrame([(DAY + datetime.timedelta(k),) for k in range(n)], "trade_date date"))


@pytest.mark.parametrize("days,total", [(range(60), 60), ([*range(20), *range(25, 50), *range(56, 80)], 80), (range(9000), 9000)])
def test_full_equals_the_recurrence(spark, days, total):
    data, df = panel(spark, days)
    got = {r.trade_date: r for r in R.full(df, calendar(spark, total)).collect()}
    want = walk([(d, c, p) for _, _, d, c, p, *_ in data], 5)
    for d, avg in want.items():
        if avg is None:
            assert got[d].avg_gain is None and got[d].rsi14 is None
        else:
            assert got[d].avg_gain == pytest.approx(avg[0], rel=1e-9) and got[d].avg_loss == pytest.approx(avg[1], rel=1e-9)
            assert 0 <= got[d].rsi14 <= 100


def test_rows_without_a_price_stay_out_of_the_walk(spark):
    data, _ = panel(spark, range(30))
    data[8] = (*data[8][:3], None, *data[8][4:])
    got = {r.trade_date: r for r in R.full(spark.createDataFrame(data, SCHEMA), calendar(spark, 30)).collect()}
    want = walk([(d, c, p) for _, _, d, c, p, *_ in data], 5)
    assert got[data[8][2]].avg_gain is None
    assert got[data[29][2]].avg_gain == pytest.approx(want[data[29][2]][0])


@pytest.mark.parametrize("cut,outcome", [(40, "updated"), (13, "seeded"), (7, "still_pre_seed"), (0, "skipped_no_workbook")])
def test_a_day_on_top_equals_the_full_recompute(spark, cut, outcome):
    data, df = panel(spark, range(cut + 1))
    cal = calendar(spark, cut + 1)
    full = R.full(df, cal)
    today = df.where(df.trade_date == data[-1][2])
    (got,) = R.advance(today, R.state_of(full.where(full.trade_date < data[-1][2])), cal).collect()
    want = full.where(full.trade_date == data[-1][2]).first()
    assert got.outcome == outcome
    if outcome in ("updated", "seeded"):
        assert got.avg_gain == pytest.approx(want.avg_gain) and got.rsi14 == want.rsi14


def test_after_a_gap(spark):
    data, df = panel(spark, [*range(30), 40])
    cal = calendar(spark, 41)
    book = R.full(df.where(df.trade_date < data[-1][2]), cal)
    today = df.where(df.trade_date == data[-1][2])
    assert R.advance(today, R.state_of(book), cal).first().outcome == "still_pre_seed"
    look = R.advance(today, R.state_of(book), cal, reseed="lookback").first()
    assert look.outcome == "reseeded_after_gap" and look.avg_gain is not None


def test_missing_price(spark):
    data, df = panel(spark, range(20))
    cal = calendar(spark, 20)
    today = spark.createDataFrame([(*data[-1][:3], None, *data[-1][4:])], SCHEMA)
    assert R.advance(today, R.state_of(R.full(df.where(df.trade_date < data[-1][2]), cal)), cal).first().outcome == "skipped_missing_price"



def test_days_one_after_the_other_on_the_state_alone(spark, tmp_path):
    data, df = panel(spark, [*range(15), *range(20, 23)], n=2)
    cal = calendar(spark, 23)
    want = {(r.isin, r.trade_date): r for r in R.full(df, cal).collect()}
    state = None
    for k, day in enumerate([*range(11, 15), *range(20, 23)]):
        date = DAY + datetime.timedelta(day)
        if state is None:
            state = R.state_of(R.full(df.where(df.trade_date < date), cal))
        got = R.advance(df.where(df.trade_date == date), state, cal)
        R.state_after(state, got).write.parquet(str(tmp_path / f"{k}"))
        state = spark.read.parquet(str(tmp_path / f"{k}"))
        if k % 2 == 0:
            for r in got.collect():
                w = want[r.isin, date]
                assert (r.avg_gain is None) == (w.avg_gain is None) and r.rsi14 == w.rsi14
                assert r.avg_gain is None or r.avg_gain == pytest.approx(w.avg_gain)


def test_a_day_reads_no_history(spark, tmp_path):
    data, df = panel(spark, range(30))
    cal = calendar(spark, 30)
    for name, x in (("state", R.state_of(R.full(df.where(df.trade_date < data[-1][2]), cal))), ("today", df.where(df.trade_date == data[-1][2])), ("cal", cal)):
        x.write.parquet(str(tmp_path / name))
    got = R.advance(*(spark.read.parquet(str(tmp_path / n)) for n in ("today", "state", "cal")))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 3 and plan.count("Join") == 2 and "Window" not in plan and "Aggregate" not in plan


def test_late_row_leaves_the_state(spark):
    data, df = panel(spark, range(20))
    cal = calendar(spark, 20)
    state = R.state_of(R.full(df, cal))
    (r,) = R.advance(df.where(df.trade_date == data[5][2]), state, cal).collect()
    assert r.outcome == "skipped_late" and r.next.session == 19


def test_empty(spark):
    assert R.full(spark.createDataFrame([], SCHEMA), calendar(spark, 3)).collect() == []


def test_one_shuffle_by_instrument(spark):
    data = [(f"S{i % 3}", "NSE", datetime.date(2024, 1, 1) + datetime.timedelta(i), float(i), float(i + 1)) for i in range(9)]
    df = spark.createDataFrame(data, "isin string, exchange string, trade_date date, close double, prev_close double")
    plan = R.full(df, calendar(spark, 30))._jdf.queryExecution().executedPlan().toString()
    assert plan.split("+- == Initial Plan ==")[0].count("Exchange hashpartitioning(isin") == 1
