import datetime

import pytest
from pyspark.sql import functions as F

from eodlake.operators.action_store import Actions
from eodlake.operators.commits import Committed
from eodlake.streaming import jobs as J
from tests.test_sources import files

DAY = datetime.date(2024, 1, 1)


def finish(query):
    query.awaitTermination()


def store_of(spark, tmp_path):
    return Committed(spark, f"file://{tmp_path}/store")


def test_files_are_loaded_once(spark, tmp_path):
    landing = tmp_path / "in"
    landing.mkdir()
    files(landing)
    store = store_of(spark, tmp_path)
    args = (spark, str(landing), store, str(tmp_path / "state"))
    finish(J.load_files(*args))
    rows = store.read("prices").collect()
    assert len(rows) == 5 and {r.exchange for r in rows} == {"NSE", "BSE"}
    assert next(r for r in rows if r.series == "EQ" and r.symbol == "AAA" and r.trade_date.year == 2024).tot_trd_qty == 3490
    loads = {r.file.rsplit("/", 1)[1]: (r.upload_status, r.total_stocks) for r in store.read("loads").collect()}
    assert loads["NSE-BC-05-JAN-2024.csv"] == ("SUCCESS", 3) and loads["BSE-BC-15-DEC-2023.csv"] == ("FAILED", 0) and loads["BSE-BC-17-DEC-2023.csv"][0] == "FAILED"
    finish(J.load_files(*args))
    (landing / "again").mkdir()
    (landing / "again" / "NSE-BC-05-JAN-2024.csv").write_text((landing / "NSE-BC-05-JAN-2024.csv").read_text())
    finish(J.load_files(*args))  # a day that has been loaded
    assert store.read("prices").count() == 5 and store.manifest()["version"] == 2


def test_counts_of_a_load_and_a_replayed_batch(spark, tmp_path):
    files(tmp_path)
    store = store_of(spark, tmp_path)
    lines = J.landed_lines(spark.read.text(str(tmp_path / "*.csv")))
    counts = J.ingested(lines, store, "b1")
    assert counts == {"files": 5, "read": 7, "duplicate": 1, "misdated": 1, "skipped": 0, "written": 5}
    assert set(J.ingested(lines, store, "b1").values()) == {0} and store.read("prices").count() == 5
    again = J.ingested(lines, store, "b2")
    assert again["written"] == 0 and again["skipped"] == 6 and store.read("prices").count() == 5


def test_a_writer_that_dies_leaves_nothing_to_see(spark, tmp_path, monkeypatch):
    store = store_of(spark, tmp_path)
    rows, loads = spark.range(3).toDF("x"), spark.range(1).toDF("y")
    assert store.commit("one", {"rows": rows, "loads": loads})

    def dies(manifest):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(store, "_published", dies)
        with pytest.raises(KeyboardInterrupt):
            store.commit("two", {"rows": rows, "loads": loads})
    assert store.read("rows").count() == 3 and store.read("loads").count() == 1
    assert store.swept() == 2
    assert store.commit("two", {"rows": rows, "loads": loads}) and not store.commit("two", {"rows": rows, "loads": loads})
    assert store.read("rows").count() == 6 and store.read("loads").count() == 2 and store.swept() == 0
    assert store.read("none", "z long").count() == 0


def test_two_writers_take_turns(spark, tmp_path, monkeypatch):
    store, other = store_of(spark, tmp_path), store_of(spark, tmp_path)
    rows = spark.range(2).toDF("x")
    first = store._published

    def later(manifest):
        monkeypatch.setattr(store, "_published", first)
        assert other.commit("theirs", {"rows": rows})
        return first(manifest)

    monkeypatch.setattr(store, "_published", later)
    assert store.commit("ours", {"rows": rows})
    assert store.read("rows").count() == 4 and store.manifest()["batches"] == ["theirs", "ours"]


def test_late_rows_change_nothing(spark, tmp_path):
    schema = "isin string, exchange string, trade_date date, session_no long, close double, prev_close double"
    row = lambda k: ("I", "NSE", DAY + datetime.timedelta(k), k, 10.0 + k % 3, 10.0)
    for part in ([row(k) for k in range(20)], [row(5), row(20)]):
        spark.createDataFrame(part, schema).write.mode("append").parquet(str(tmp_path / "in"))
        stream = J.rsi_stream(spark.readStream.schema(schema).parquet(str(tmp_path / "in")))
        finish(stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start())
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert len(got) == 22 and [r.session_no for r in got if r.late] == [5]
    last = next(r for r in got if r.session_no == 20)
    assert last.avg_gain is not None and not last.late


def test_instruments_of_a_stream_share_groups_and_not_states(spark, tmp_path):
    """Spark hands over groups, not single instruments; each keeps averages and state of its own, those of a null exchange too."""
    from eodlake.operators import rsi as R

    schema = "isin string, exchange string, trade_date date, session_no long, close double, prev_close double"
    row = lambda i, k: (f"I{i}", "NSE" if i % 5 else None, DAY + datetime.timedelta(k), k, 10.0 + (k * i) % 7, None if (i, k) == (3, 30) else 10.0 + k % 3)
    df = spark.createDataFrame([row(i, k) for i in range(40) for k in range(45) if k % (13 + i) or k < 3], schema)
    cal = R.sessions(spark.createDataFrame([(DAY + datetime.timedelta(k),) for k in range(45)], "trade_date date"))
    book = R.state_of(R.full(df.where("session_no < 10 and isin <> 'I7'").drop("session_no"), cal))
    for low, high in ((10, 25), (25, 45)):
        df.where(f"session_no >= {low} and session_no < {high} and (isin <> 'I8' or session_no > 25)").write.mode("append").parquet(str(tmp_path / "in"))
        stream = J.rsi_stream(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), initial=book, groups=3)
        finish(stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start())
    kept = df.where("(isin <> 'I7' or session_no >= 10) and (isin <> 'I8' or session_no < 10 or session_no > 25)").drop("session_no")
    full = R.full(kept, cal)
    plain = lambda x: None if x is None else round(x, 9)
    of = lambda rows: sorted((r.isin, str(r.exchange), r.session_no, plain(r.avg_gain), plain(r.avg_loss), None if r.rsi14 is None else round(float(r.rsi14), 2)) for r in rows)
    got, want = (of(x.collect()) for x in (spark.read.parquet(str(tmp_path / "out")), full.where("session_no >= 10")))
    assert [str(g) for g in got] == [str(w) for w in want]
    rounded = lambda r: (r.isin, str(r.exchange), plain(r.avg_gain), r.n, plain(r.sum_gain), r.session, [plain(x.gain) for x in r.recent])
    assert sorted(map(str, map(rounded, J.states(spark, str(tmp_path / "state")).collect()))) == sorted(map(str, map(rounded, R.state_of(full).collect())))
    keys = spark.read.format("statestore").option("stateVarName", "instrument").load(str(tmp_path / "state"))
    assert keys.count() == 40 and keys.select("key").distinct().count() <= 3


def test_stream_goes_on_from_a_workbook_and_its_states_are_readable(spark, tmp_path):
    from eodlake.operators import rsi as R

    schema = "isin string, exchange string, trade_date date, session_no long, close double, prev_close double"
    row = lambda k: ("I", "NSE", DAY + datetime.timedelta(k), k, 10.0 + k % 3, 10.0 + (k * 7) % 5)
    every = [row(k) for k in [*range(20), *range(26, 60)]]
    df = spark.createDataFrame(every, schema)
    cal = R.sessions(spark.createDataFrame([(DAY + datetime.timedelta(k),) for k in range(60)], "trade_date date"))
    want = {r.session_no: r.avg_gain for r in R.full(df.drop("session_no"), cal).collect()}
    state = R.state_of(R.full(df.where("session_no < 10").drop("session_no"), cal))
    df.where("session_no >= 10").repartition(1).write.parquet(str(tmp_path / "in"))
    stream = J.rsi_stream(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), initial=state)
    finish(stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start())
    got = {r.session_no: r.avg_gain for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got.keys() == {k for k in want if k >= 10}
    assert all(got[k] == want[k] if want[k] is None else abs(got[k] - want[k]) < 1e-9 for k in got)
    (kept,) = J.states(spark, str(tmp_path / "state")).collect()
    (plain,) = R.state_of(R.full(df.drop("session_no"), cal)).collect()
    assert (kept.n, kept.session, len(kept.recent)) == (plain.n, plain.session, 13) and abs(kept.avg_gain - plain.avg_gain) < 1e-9


def test_a_failure_switches_off_until_activated(spark, tmp_path):
    spark.createDataFrame([(DAY,)], "trade_date date").write.parquet(str(tmp_path / "in"))
    days = spark.readStream.schema("trade_date date").parquet(str(tmp_path / "in"))
    jobs, seen, state = J.Indicators(store_of(spark, tmp_path), ["RSI14"]), [], str(tmp_path / "state")

    def work(df):
        raise ValueError("no prices")

    try:
        assert not jobs.run(days, "RSI14", work, state)
        (f,) = jobs.store.read("failures").collect()
        assert (f.indicator_id, f.trade_date) == ("RSI14", DAY) and "no prices" in f.error_message
        assert jobs.store.read("registry").first().status == "DEACTIVE"
        assert not jobs.run(days, "RSI14", seen.append, state) and not seen  # off
        jobs.activate("RSI14")
        assert jobs.run(days, "RSI14", lambda df: seen.append(df.count()), state)
        assert seen == [1] and jobs.store.read("failures").isEmpty()  # the failed batch came again
        assert jobs.store.read("cursor").first().latest_trade_date == DAY
    finally:
        jobs.close()


def test_window_of_actions_rebuilds_new_matches_only(spark, tmp_path):
    schema = "isin string, exchange string, symbol string, ex_date date, subject string, seq long"
    asked = []

    def rebuild(isins, actions):
        asked.append(sorted(r.isin for r in isins.collect()))
        return actions.select("isin", F.col("adjustment_factor").alias("f"))

    actions = Actions(store_of(spark, tmp_path), rebuild)
    parts = (
        [("I", "NSE", "A", DAY, "Bonus 1:1", 1), ("I", "NSE", "A", DAY, "Bonus 2:1", 2), ("I", "NSE", "A", DAY - datetime.timedelta(90), "Bonus 1:1", 3), ("K", "NSE", "B", DAY, "Bonus 1:1", 4)],
        [("I", "BSE", "A", DAY, "Bonus 2:1", 5)],
        [("I", "NSE", "A", DAY, "Bonus 2:1", 6), ("K", "NSE", "B", DAY, "dividend", 7)],
    )
    for part in parts:
        spark.createDataFrame(part, schema).write.mode("append").parquet(str(tmp_path / "in"))
        finish(J.action_window(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), "2024-01-03", actions, checkpoint=str(tmp_path / "state")))
    assert asked == [[], ["I"], []]
    raw = {(r.isin, r.exchange): (r.seq, float(r.face_value_old)) for r in actions.raw().collect()}
    assert raw == {("I", "NSE"): (6, 3.0), ("I", "BSE"): (5, 3.0), ("K", "NSE"): (4, 2.0)}
    assert {r.isin: r.reconciliation_status for r in actions.reconciled().collect()} == {"I": "MATCHED", "K": "NSE_ONLY"}
    assert [(r.isin, round(float(r.f), 6)) for r in actions.rebuilt().collect()] == [("I", 0.333333)]
    assert [(r.rows, r.touched, r.matched) for r in actions.store.read("runs").orderBy("version").collect()] == [(2, 2, 0), (1, 1, 1), (1, 1, 0)]
    assert not actions.apply(spark.createDataFrame(parts[1], schema), "state-1")


def test_gate_runs_once_for_each_newest_attempt(spark, tmp_path):
    runs, store = [], store_of(spark, tmp_path)
    parts = ([(1, "a", "success")], [(2, "b", "failed")], [(3, "b", "success")], [(3, "b", "success")], [(4, "a", "success")])

    def work():
        runs.append(1)
        return "FAILED" if len(runs) == 2 else "PARTIAL"

    for part in parts:
        spark.createDataFrame(part, J.UPLOADS).write.mode("append").parquet(str(tmp_path / "in"))
        finish(J.gated(spark.readStream.schema(J.UPLOADS).parquet(str(tmp_path / "in")), ["a", "b"], store, work, str(tmp_path / "state")))
    assert [(r.is_ready, r.ran) for r in store.read("gates").orderBy("batch").collect()] == [(False, False), (False, False), (True, True), (True, False), (True, True)]
    assert [(r.max_id, r.status) for r in store.read("runs").orderBy("id").collect()] == [(3, "PARTIAL"), (4, "FAILED")]
    assert store.read("log").count() == 5
    # a batch that comes again: from an empty checkpoint all come as batch 0, which is done
    finish(J.gated(spark.readStream.schema(J.UPLOADS).parquet(str(tmp_path / "in")), ["a", "b"], store, work, str(tmp_path / "again" / "state")))
    assert len(runs) == 2 and store.read("log").count() == 5


def test_compaction_keeps_rows_and_what_comes_meanwhile(spark, tmp_path, monkeypatch):
    store, other = store_of(spark, tmp_path), store_of(spark, tmp_path)
    rows = spark.range(2).toDF("x")
    for k in range(5):
        store.commit(f"b{k}", {"rows": rows.withColumn("x", rows.x + 10 * k), "loads": rows})
    assert not store.compacted("rows", 5) and not store.compacted("none")
    first = store._published

    def later(manifest):
        monkeypatch.setattr(store, "_published", first)
        assert other.commit("theirs", {"rows": rows.withColumn("x", rows.x + 100)})
        return first(manifest)

    monkeypatch.setattr(store, "_published", later)
    assert store.compacted("rows", 2)
    want = sorted([10 * k + i for k in range(5) for i in range(2)] + [100, 101])
    assert sorted(r.x for r in store.read("rows").collect()) == want and store.read("loads").count() == 10
    assert len(store.manifest()["tables"]["rows"]["folders"]) == 2 and not store.commit("b0", {"rows": rows})
    assert store.swept() == 5 and len(store._versions()) == 2
    assert sorted(r.x for r in store.read("rows").collect()) == want

    def replaced(manifest):
        monkeypatch.setattr(store, "_published", first)
        assert other.commit("anew", {"rows": rows}, replace=("rows",))
        return first(manifest)

    monkeypatch.setattr(store, "_published", replaced)
    assert not store.compacted("rows", 1) and sorted(r.x for r in store.read("rows").collect()) == [0, 1]
