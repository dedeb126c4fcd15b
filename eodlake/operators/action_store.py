"""Corporate actions as a change set: what a batch touches is reconciled, and what newly matches is rebuilt, nothing else."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from eodlake.operators import actions as A
from eodlake.operators.commits import Committed

RAW_KEY = ["isin", "exchange", "action_type", "ex_date"]
RAW = "isin string, exchange string, symbol string, ex_date date, seq long, subject string, action_type string, face_value_old decimal(20,6), face_value_new decimal(20,6), version long"
RECONCILED = "isin string, action_type string, ex_date date, symbol string, adjustment_factor decimal(20,6), nse_confirmed boolean, bse_confirmed boolean, reconciliation_status string, version long"
RUNS = "version long, rows long, unmatched long, unparsed long, touched long, matched long, rebuilt long"


def newest(rows: DataFrame, keys: list[str], *then: str) -> DataFrame:
    """Of each key the rows of its newest version (and, if named, the last by ``then``): the tables are logs, and this is what counts of them."""
    order = [F.col(c).desc() for c in ("version", *then)]
    w = W.partitionBy(*keys).orderBy(*order)
    number = F.row_number().over(w) if then else F.rank().over(w)
    return rows.withColumn("_n", number).where("_n = 1").drop("_n")


class Actions:
    """Tables ``raw``, ``reconciled``, ``rebuilt`` and ``runs`` of one store; each batch appends a version to them in one commit.

    ``rebuild`` (isins, actions) gives the rows of a derived table (with isin) for those instruments from their matched actions. A batch reads of
    the stored tables only its own keys and its instruments (semi joins), so its cost follows what it touches.
    """

    def __init__(self, store: Committed, rebuild: Callable[[DataFrame, DataFrame], DataFrame]):
        self.store, self.rebuild = store, rebuild

    def raw(self) -> DataFrame:
        return newest(self.store.read("raw", RAW), RAW_KEY, "seq", "subject")

    def reconciled(self) -> DataFrame:
        return newest(self.store.read("reconciled", RECONCILED), A.KEY).drop("version")

    def rebuilt(self) -> DataFrame:
        return newest(self.store.read("rebuilt"), ["isin"]).drop("version")

    def apply(self, rows: DataFrame, batch: str, unmatched: int = 0) -> bool:
        """Action rows (isin, exchange, symbol, ex_date, seq, subject) of one batch; false for a batch that was applied before.

        Classified rows go to the raw log, where the last of a key counts. The keys they touch are reconciled from what is stored of them, the result is held
        against the stored reconciliation, and instruments with a newly matched action are rebuilt with all their matched actions.
        """
        new = A.parsed(rows.where("isin is not null and symbol is not null and ex_date is not null"))
        return self._applied(new, batch, unmatched, False)

    def repair(self, batch: str) -> bool:
        """Stored splits without ratios, extracted again from their stored texts; whatever factor that changes is rebuilt."""
        lost = self.raw().where("action_type = 'SPLIT' and (face_value_old is null or face_value_new is null)")
        again = A.parsed(lost.drop("version", "action_type", "face_value_old", "face_value_new"))
        return self._applied(again.where("face_value_old is not null and face_value_new is not null"), batch, 0, True)

    def _applied(self, rows: DataFrame, batch: str, unmatched: int, on_factor_change: bool) -> bool:
        store = self.store
        manifest = store.manifest()
        if batch in manifest["batches"]:
            return False
        version = F.lit(manifest["version"] + 1).cast("long").alias("version")
        names = [c.split()[0] for c in RAW.replace("(20,6)", "").split(", ")][:-1]
        new = A.latest_wins(rows, RAW_KEY, F.struct("seq", "subject")).select(*names, version)
        raw = store.staged("raw", new)
        new = store.spark.read.schema(new.schema).parquet(raw)
        touched = new.select(*A.KEY).distinct()
        own = store.read("raw", RAW).join(touched, A.KEY, "left_semi").unionByName(new)
        now = A.reconciled(newest(own, RAW_KEY, "seq", "subject").drop("version")).select("*", version)
        after = store.staged("reconciled", now)
        now = store.spark.read.schema(now.schema).parquet(after)
        before = newest(store.read("reconciled", RECONCILED).join(touched, A.KEY, "left_semi"), A.KEY)
        isins = A.newly_matched(now, before, on_factor_change).select("isin").distinct()
        theirs = newest(store.read("reconciled", RECONCILED).unionByName(now).join(isins, "isin", "left_semi"), A.KEY).drop("version")
        rebuilt = self.rebuild(isins, theirs).select("*", version)
        derived = store.staged("rebuilt", rebuilt)
        size = new.agg(F.count("*").alias("rows"), F.count_if(F.col("face_value_old").isNull()).alias("unparsed"), F.count_distinct(*A.KEY).alias("touched"))
        matched = isins.agg(F.count("*").alias("matched"))
        made = store.spark.read.schema(rebuilt.schema).parquet(derived).agg(F.count("*").alias("rebuilt"))
        run = size.crossJoin(matched).crossJoin(made).select(version, "rows", F.lit(unmatched).cast("long").alias("unmatched"), "unparsed", "touched", "matched", "rebuilt")  # one row each
        return store.publish(batch, {"raw": (raw, new.schema), "reconciled": (after, now.schema), "rebuilt": (derived, rebuilt.schema), "runs": (store.staged("runs", run), run.schema)})
