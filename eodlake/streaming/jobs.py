"""Polling jobs as Structured Streaming queries: new files, released days, per-instrument RSI state, gated batches."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from threading import Event

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.errors import StreamingQueryException
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from eodlake.operators import enrichment as E
from eodlake.operators import rsi as R
from eodlake.operators import tables as T
from eodlake.operators.action_store import Actions
from eodlake.operators.commits import Committed
from eodlake.plans.shared import fresh
from eodlake.sources import prices as P

METADATA = "trade_date date, exchange string, file string, total_stocks long, upload_status string, error_message string"


def landed_lines(source: DataFrame) -> DataFrame:
    """(file, start, value) of a text source, streamed or not."""
    return source.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")


def ingested(lines: DataFrame, store: Committed, batch: str) -> dict[str, int]:
    """Price files into the tables ``prices`` and ``loads`` of ``store``, rows and load records together; what was read, left out and written.

    Files are parsed once: rows are staged with what is wrong with each (a day that isn't the file's, a key seen before in the file), summed up to a row a file, and
    everything else reads these two; no file's rows have to meet in one task. A file with a wrong day fails as a whole; a day and exchange
    that loaded before is skipped; a batch that has been committed before changes nothing.
    """
    spark = lines.sparkSession
    counts = {"files": 0, "read": 0, "duplicate": 0, "misdated": 0, "skipped": 0, "written": 0}
    if batch in store.manifest()["batches"]:
        return counts
    # the lines of a split are numbered as they are read, so (start of the split, number) grows along a file
    rows, rejects = P.from_lines(lines.withColumn("at", F.struct("start", F.monotonically_increasing_id().alias("n"))).drop("start"))
    exchange, day = P.file_facts(F.col("file"))
    wrong = ~(F.col("trade_date").eqNullSafe(day) & F.col("exchange").eqNullSafe(exchange))
    keys = [F.coalesce(c, F.lit("")) for c in ("isin", "symbol", "series")]
    rows = rows.withColumns({"wrong": wrong, "nth": F.row_number().over(W.partitionBy("file", *keys).orderBy("line"))}).drop("line")
    staged = fresh(spark, "parsed")
    rows.write.parquet(staged)
    parsed = spark.read.schema(rows.schema).parquet(staged)
    loaded = store.read("loads", METADATA).where("upload_status = 'SUCCESS'").select(F.col("trade_date").alias("_day"), F.col("exchange").alias("_x"), F.lit(True).alias("known")).distinct()
    files = parsed.groupBy("file").agg(F.count("*").alias("read"), F.count_if(F.col("nth") == 1).alias("n"), F.bool_or("wrong").alias("bad"))
    files = files.join(loaded, (day == F.col("_day")) & (exchange == F.col("_x")), "left").select("file", "read", "n", "bad", F.coalesce("known", F.lit(False)).alias("known"))
    summed = store.spark.read.schema(files.schema).parquet(store.staged("files", files))  # a row a file
    total = lambda c, which: F.coalesce(F.sum(F.when(F.expr(which), F.expr(c))), F.lit(0))
    fine = "not known and not bad"
    counts |= summed.agg(total("read", "true").alias("read"), total("read - n", fine).alias("duplicate"), total("read", "not known and bad").alias("misdated"), total("read", "known").alias("skipped"), total("n", fine).alias("written")).first().asDict()
    written = parsed.where("nth = 1").join(summed.where(fine), "file", "left_semi").drop("wrong", "nth")
    failed = F.when(F.col("bad"), "trade date of a row is not the file's")
    loads = summed.where("not known").select(day.alias("trade_date"), exchange.alias("exchange"), "file", F.when(F.col("bad"), 0).otherwise(F.col("n")).cast("long").alias("total_stocks"), F.when(F.col("bad"), "FAILED").otherwise("SUCCESS").alias("upload_status"), failed.alias("error_message"))
    unread = rejects.select(day.alias("trade_date"), exchange.alias("exchange"), "file", F.lit(0).cast("long").alias("total_stocks"), F.lit("FAILED").alias("upload_status"), F.lit("no price file").alias("error_message"))
    loads_seen = Observation()
    loads = loads.unionByName(unread).observe(loads_seen, F.count("*").alias("files"))
    store.commit(batch, {"prices": written.select([c for c in rows.columns if c not in ("wrong", "nth")]), "loads": loads})
    return counts | {"files": loads_seen.get["files"]}


def load_files(spark: SparkSession, landing: str, store: Committed, checkpoint: str, pattern: str = "*.csv") -> StreamingQuery:
    """Each landed price file once, as ``ingested`` does. The batch's number names its commit, so a batch that comes again after a crash adds nothing."""
    source = spark.readStream.format("text").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(landing)
    name = checkpoint.rstrip("/").rsplit("/", 1)[-1]

    def batch(df: DataFrame, number: int) -> None:
        ingested(df, store, f"{name}-{number}")

    return landed_lines(source).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def release_days(loads: DataFrame, released: str, checkpoint: str) -> StreamingQuery:
    """A day goes to ``released`` once, when both exchanges have loaded it: state is the exchanges seen of each day."""

    def seen(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        before = set(state.get[0].split(",")) - {""} if state.exists else set()
        now = before.union(*(set(f["exchange"]) for f in frames))
        state.update((",".join(sorted(now)),))
        if len(before) < 2 <= len(now):
            yield pd.DataFrame({"trade_date": [key[0]]})

    done = loads.where("upload_status = 'SUCCESS'").select("trade_date", "exchange")
    days = done.groupBy("trade_date").applyInPandasWithState(seen, "trade_date date", "exchanges string", "append", GroupStateTimeout.NoTimeout)
    return days.writeStream.format("parquet").option("path", released).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def in_time(loads: DataFrame, store: Committed, checkpoint: str, lateness: str = "3 days") -> StreamingQuery:
    """Load records (trade_date, exchange, upload_status) that come within ``lateness`` of the newest day seen, once a day and exchange, into ``accepted``.

    The watermark is the cursor: a record behind it is dropped by Spark, so its day is not released however complete it is in the end; ``late`` lists such
    records and a full recompute is the remedy. State is kept for the days within ``lateness`` only.
    """
    timed = loads.where("upload_status = 'SUCCESS'").withColumn("at", F.col("trade_date").cast("timestamp")).withWatermark("at", lateness)
    once = timed.dropDuplicatesWithinWatermark(["trade_date", "exchange"]).select("trade_date", "exchange")
    name = checkpoint.rstrip("/").rsplit("/", 1)[-1]

    def batch(df: DataFrame, number: int) -> None:
        store.commit(f"{name}-{number}", {"accepted": df})

    return once.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def released(store: Committed) -> DataFrame:
    """Days whose both exchanges were in time."""
    return store.read("accepted", "trade_date date, exchange string").groupBy("trade_date").agg(F.count_distinct("exchange").alias("n")).where("n = 2").select("trade_date")


def late(loads: DataFrame, store: Committed) -> DataFrame:
    """Load records that came behind the watermark: those of no day and exchange that was accepted."""
    done = store.read("accepted", "trade_date date, exchange string")
    return loads.where("upload_status = 'SUCCESS'").select("trade_date", "exchange").distinct().join(done, ["trade_date", "exchange"], "left_anti")


RSI_ROWS = "isin string, exchange string, trade_date date, session_no long, avg_gain double, avg_loss double, rsi14 double, late boolean"
INSTRUMENT, VALUES = ", ".join(R.STATE.split(", ", 2)[:2]), R.STATE.split(", ", 2)[2]
#: Groups that a stream's instruments are dealt over, if its caller does not know their number.
GROUPS = 256


def smoothed(x: np.ndarray, start: float) -> np.ndarray:
    """Wilder's averages of ``x`` from ``start``: (13 * previous + x) / 14, a scaled running sum of 2048 rows at a time."""
    keep, out = (R.PERIOD - 1) / R.PERIOD, []
    for i in range(0, len(x), 2048):
        part = x[i : i + 2048]
        scale = keep ** np.arange(1, len(part) + 1)
        out.append(scale * (start + np.cumsum(part / scale) / R.PERIOD))
        start = out[-1][-1]
    return np.concatenate(out) if out else np.empty(0)


def walked(state: tuple | None, session: np.ndarray, changes: np.ndarray, gap: int) -> tuple[np.ndarray, tuple]:
    """Averages after each of an instrument's rows (gain and loss, in order of session, all after the state's) and the state after the last.

    The rows are cut at gaps; each piece is the rest of a seed's rows and one smoothing.
    """
    avg, n, sums, last, recent = None, 0, np.zeros(2), None, []
    if state is not None:
        avg = None if state[0] is None else np.array(state[:2])
        n, sums, last, recent = state[2], np.array(state[3:5]), state[5], [tuple(r) for r in state[6]]
    out = np.full((len(session), 2), np.nan)
    missed = np.diff(session, prepend=session[0] if last is None else last) - 1
    cuts = np.flatnonzero(missed >= gap)
    for part in np.split(np.arange(len(session)), cuts):
        if len(part) and missed[part[0]] >= gap:
            avg, n, sums = None, 0, np.zeros(2)
        x = changes[part]
        if avg is None and n + len(part) >= R.PERIOD:
            k = R.PERIOD - n
            avg = (sums + x[:k].sum(0)) / R.PERIOD
            sums = sums + x[: k - 1].sum(0)
            out[part[k - 1]] = avg
            part, n, x = part[k:], R.PERIOD, x[k:]
        elif avg is None:
            n, sums = n + len(part), sums + x.sum(0)
            continue
        if len(part):
            out[part] = np.column_stack([smoothed(x[:, c], avg[c]) for c in (0, 1)])
            avg, n = out[part[-1]], n + len(part)
    recent = [*recent, *map(tuple, changes.tolist())][1 - R.PERIOD :]
    g, lo = (None, None) if avg is None else map(float, avg)
    return out, (g, lo, int(n), float(sums[0]), float(sums[1]), int(session[-1]), recent)


class Instruments(StatefulProcessor):
    """States (``VALUES``) of a group of instruments, a map entry each, set up from a batch workbook and moved on by each batch's rows.

    A group is handed to Python as a whole, so what a call costs is shared by its instruments; a batch reads and writes the entries of its own instruments only.
    """

    def __init__(self, gap: int):
        self.gap = gap

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getMapState("instrument", INSTRUMENT, VALUES)

    def handleInitialState(self, key: tuple, initial: pd.DataFrame, timers: object) -> None:
        none = lambda v: None if pd.isna(v) else float(v)
        for r in initial.itertuples(index=False):
            recent = [(x["gain"], x["loss"]) if isinstance(x, dict) else tuple(x) for x in r.recent]
            self.state.updateValue(_instrument(r.isin, r.exchange), (none(r.avg_gain), none(r.avg_loss), int(r.n), float(r.sum_gain), float(r.sum_loss), int(r.session), recent))

    def handleInputRows(self, key: tuple, frames: Iterator[pd.DataFrame], timers: object) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(frames), ignore_index=True)
        own = rows.groupby(R.KEYS, sort=False, dropna=False).ngroup().to_numpy()
        order = np.lexsort((rows["session_no"].to_numpy(), own))  # stable
        rows, own = rows.iloc[order].reset_index(drop=True), own[order]
        isin, exchange, session = (rows[c].to_numpy() for c in (*R.KEYS, "session_no"))
        change = (rows["close"] - rows["prev_close"]).to_numpy(float)
        changes = np.column_stack([np.maximum(change, 0), np.maximum(-change, 0)])
        late, avg = np.zeros(len(rows), bool), np.full((len(rows), 2), np.nan)
        starts = np.flatnonzero(np.diff(own, prepend=-1))
        for low, high in zip(starts, [*starts[1:], len(rows)]):
            name = _instrument(isin[low], exchange[low])
            kept = self.state.getValue(name)
            if kept is not None:
                late[low:high] = session[low:high] <= kept[5]
            fine = low + np.flatnonzero(~late[low:high] & ~np.isnan(change[low:high]))
            if len(fine):
                avg[fine], after = walked(kept, session[fine], changes[fine], self.gap)
                self.state.updateValue(name, after)
        g, lo = avg.T
        with np.errstate(divide="ignore", invalid="ignore"):
            rsi = np.where((g == 0) & (lo == 0), np.nan, np.where(lo == 0, 100.0, 100 - 100 / (1 + g / lo)))
        yield pd.DataFrame({"isin": rows["isin"], "exchange": rows["exchange"], "trade_date": rows["trade_date"], "session_no": session, "avg_gain": g, "avg_loss": lo, "rsi14": rsi, "late": late})

    def close(self) -> None:
        pass


def _instrument(*key: object) -> tuple:
    return tuple(None if pd.isna(k) else k for k in key)


def rsi_stream(prices: DataFrame, gap: int = R.GAP, initial: DataFrame | None = None, groups: int = GROUPS) -> DataFrame:
    """RSI rows of a stream of prices that carry their session number; a state an instrument, late rows marked.

    ``initial`` (``rsi.STATE``, as ``rsi.state_of`` makes it of a workbook) is where the stream starts. Instruments are dealt over ``groups``, some hundreds of them to each;
    the number stays what it was when a checkpoint began. The state lives in RocksDB beside the checkpoint and batch jobs read it by ``states``.
    """
    prices.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    group = F.pmod(F.hash(*R.KEYS), F.lit(groups)).alias("group")
    rows = prices.select(group, "isin", "exchange", "trade_date", "session_no", "close", "prev_close").groupBy("group")
    first = None if initial is None else initial.select(group, "*").groupBy("group")
    out = rows.transformWithStateInPandas(Instruments(gap), RSI_ROWS, "Append", "None", first)
    value = lambda c: F.when(~F.isnan(c), F.col(c)).alias(c) if c in ("avg_gain", "avg_loss", "rsi14") else F.col(c)
    return out.select(*map(value, out.columns))


def states(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The states (``rsi.STATE``) that an RSI stream has reached, from its checkpoint by the state data source."""
    kept = spark.read.format("statestore").option("stateVarName", "instrument").load(checkpoint)
    return kept.select("user_map_key.*", "user_map_value.*").select(*R.KEYS, *R.STATE_FIELDS)


REGISTRY = "indicator_id string, status string"
CURSOR = "indicator_id string, latest_trade_date date, status string, date_of_run timestamp"
FAILURES = "indicator_id string, trade_date date, error_message string, failed_at timestamp"


class Indicators(StreamingQueryListener):
    """Registry, cursor and failures of the indicators in one store; the only place that switches an indicator off.

    A query is named after its indicator. When one ends with an error the listener writes the failed day and DEACTIVE in one commit, and
    the indicator is not started again until ``activate``. The failed batch stays uncommitted in the checkpoint, so a restart begins at the
    day after the cursor.
    """

    def __init__(self, store: Committed, ids: list[str]):
        self.store, self.working, self.ended = store, {}, {}
        spark = store.spark
        store.commit("registry", {"registry": spark.createDataFrame([(i, "ACTIVE") for i in ids], REGISTRY), "cursor": spark.createDataFrame([], CURSOR), "failures": spark.createDataFrame([], FAILURES)})
        spark.streams.addListener(self)

    def close(self) -> None:
        self.store.spark.streams.removeListener(self)

    def onQueryStarted(self, event: object) -> None:
        pass

    def onQueryProgress(self, event: object) -> None:
        pass

    def onQueryIdle(self, event: object) -> None:
        pass

    def onQueryTerminated(self, event: object) -> None:
        run = str(event.runId)
        if event.exception and run in self.working:
            lost = self.store.spark.createDataFrame([self.working[run]], "indicator_id string, trade_date date, error_message string").withColumn("failed_at", F.current_timestamp())
            registry, failures = T.failed(self.store.read("registry"), self.store.read("failures"), lost)
            self.store.commit(f"failed-{run}", {"registry": registry, "failures": failures}, replace=("registry", "failures"))
        self.ended.setdefault(run, Event()).set()

    def activate(self, indicator: str) -> None:
        """What an operator does after a failure."""
        status = F.when(F.col("indicator_id") == indicator, "ACTIVE").otherwise(F.col("status")).alias("status")
        self.store.commit(f"activate-{indicator}-{uuid.uuid4().hex}", {"registry": self.store.read("registry").select("indicator_id", status)}, replace=("registry",))

    def run(self, days: DataFrame, indicator: str, work: Callable[[DataFrame], None], checkpoint: str) -> bool:
        """``work`` for each batch of the streamed ``days``, the cursor moved and the day's failure removed in one commit after it; whether all went well. An indicator that is off isn't started."""
        active = self.store.read("registry").where((F.col("indicator_id") == indicator) & (F.col("status") == "ACTIVE"))
        if active.isEmpty():
            return False
        started: dict[str, str] = {}

        def batch(df: DataFrame, number: int) -> None:
            span = df.agg(F.min("trade_date").alias("low"), F.max("trade_date").alias("high")).first()
            if span.high is None:
                return
            self.working[started["run"]] = (indicator, span.low, "the query ended before its work did")
            try:
                work(df)
            except Exception as e:
                self.working[started["run"]] = (indicator, span.low, str(e)[:500])
                raise
            done = df.select(F.lit(indicator).alias("indicator_id"), "trade_date", F.current_timestamp().alias("at")).distinct()
            cursor, failures = T.succeeded(self.store.read("cursor"), self.store.read("failures"), done)
            self.store.commit(f"{checkpoint}-{number}", {"cursor": cursor, "failures": failures}, replace=("cursor", "failures"))

        go = Event()

        def gated_batch(df: DataFrame, number: int) -> None:
            go.wait()
            batch(df, number)

        query = days.writeStream.foreachBatch(gated_batch).queryName(indicator).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        run = started["run"] = str(query.runId)
        ended = self.ended.setdefault(run, Event())
        go.set()
        try:
            query.awaitTermination()
        except StreamingQueryException:
            pass
        ended.wait(60)  # events come after the query's end
        return query.exception() is None


def action_window(landed: DataFrame, today: str, actions: Actions, back: int = 7, ahead: int = 30, checkpoint: str = "") -> StreamingQuery:
    """Landed action rows within the window around ``today``, applied batch by batch: only new matches rebuild anything, and a batch that comes again changes nothing."""
    day = F.lit(today).cast("date")
    name = checkpoint.rstrip("/").rsplit("/", 1)[-1]

    def batch(df: DataFrame, number: int) -> None:
        actions.apply(df.where(F.col("ex_date").between(F.date_sub(day, back), F.date_add(day, ahead))), f"{name}-{number}")

    return landed.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


UPLOADS = "id long, data_source string, status string"
RUNS = "id long, batch long, max_id long, status string"


def gated(uploads: DataFrame, required: list[str], store: Committed, work: Callable[[], str], checkpoint: str) -> StreamingQuery:
    """Runs ``work`` when the latest attempt of every required source succeeded and there is one newer than the cursor.

    ``work`` returns the run's status; the cursor is that of the newest SUCCESS or PARTIAL run. ``log`` has all attempts, ``gates`` what each batch found, ``runs`` the runs. Each
    is committed under the batch's number, so a batch that comes again after a crash appends nothing and does not run a second time. The log is
    summed up by source and batch, and a batch reads the sums.
    """
    name = checkpoint.rstrip("/").rsplit("/", 1)[-1]

    def batch(df: DataFrame, number: int) -> None:
        newest = df.groupBy("data_source").agg(F.max_by("status", "id").alias("status"), F.max("id").alias("id")).select("id", "data_source", "status")
        store.commit(f"{name}-log-{number}", {"log": df, "newest": newest})
        done = store.manifest()["batches"]
        if f"{name}-gate-{number}" in done:
            return
        gate = E.ready(store.read("newest", UPLOADS), required).first()
        runs = store.read("runs", RUNS)
        goes = bool(gate.is_ready) and gate.max_id > E.cursor(runs).first().cursor
        spark = df.sparkSession
        found = {"gates": spark.createDataFrame([(number, bool(gate.is_ready), gate.max_id, goes)], "batch long, is_ready boolean, max_id long, ran boolean")}
        if goes:
            found["runs"] = spark.createDataFrame([(runs.count() + 1, number, gate.max_id, work())], RUNS)
        store.commit(f"{name}-gate-{number}", found)

    return uploads.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
