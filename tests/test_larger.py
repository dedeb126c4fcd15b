"""Queries over tables as larger copies have them: keys beyond those of the small tables, more of each kind."""

import os

import duckdb
import pytest

from eodlake import queries
from tests.compare import connect, same

FOLDER = "/root/testdata/sf0.001"


def shifted(folder, **keys):
    """A folder with the small tables' files, ``keys`` (a table: SQL that replaces its columns) in tables of their own."""
    for name in os.listdir(FOLDER):
        table = name.removesuffix(".parquet")
        if table in keys:
            duckdb.connect().execute(f"COPY (SELECT * REPLACE ({keys[table]}) FROM '{FOLDER}/{name}') TO '{folder}/{name}' (FORMAT parquet)")
        else:
            os.symlink(f"{FOLDER}/{name}", f"{folder}/{name}")
    return str(folder)


@pytest.mark.parametrize("name", ["jon11_tiers", "job5_enriched_master"])
def test_numbers_of_later_tiers_are_kept_as_they_are(spark, tmp_path, name):
    folder = shifted(tmp_path, supplier="s_suppkey + 20000 AS s_suppkey")
    same(queries.QUERIES[name](spark, folder), connect(folder), queries.ORACLES[name])


def test_rows_without_a_series_are_projected(spark, tmp_path):
    folder = shifted(tmp_path, lineitem="nullif(l_returnflag, 'R') AS l_returnflag, CASE WHEN l_orderkey % 2 = 0 THEN l_linestatus ELSE 'O' END AS l_linestatus")
    same(queries.QUERIES["src3_layout_projection"](spark, folder), connect(folder), queries.ORACLES["src3_layout_projection"])


def test_each_gated_run_gives_the_whole_enriched_master(spark):
    master = queries.QUERIES["job5_enriched_master"](spark, FOLDER)
    rows = queries.QUERIES["str7_gated_enrichment"](spark, FOLDER).collect()
    ran = {r.batch for r in rows if r.ran}
    assert ran and {r.batch for r in rows} == set(range(8))
    for batch in ran:
        assert sorted(map(str, (tuple(r[c] for c in master.columns) for r in rows if r.batch == batch))) == sorted(map(str, map(tuple, master.collect())))


def test_products_of_factors_are_not_off_at_a_rounding_edge(spark):
    """0.5 x 0.333333 = 0.1666665: by logarithms it falls below the edge."""
    folder = "/root/testdata/sf0.01"
    same(queries.QUERIES["agg4_product"](spark, folder), connect(folder), queries.ORACLES["agg4_product"])


def test_a_price_file_is_not_gathered_in_one_task(spark, tmp_path):
    """No window over a whole file in the plan: rows stay dealt as they were read."""
    from eodlake.sources import prices as P

    (tmp_path / "a.csv").write_text("SYMBOL,ISIN,CLOSE,TIMESTAMP\n" + "".join(f"P{i},S{i},{i}.5,05-Jan-2024\n" for i in range(500)))
    rows, _ = P.scan(spark, str(tmp_path))
    assert "Window" not in rows._jdf.queryExecution().optimizedPlan().toString()
    assert rows.count() == 500 and rows.where("close = 499.5 and trade_date = date'2024-01-05' and exchange = 'NSE'").count() == 1


def test_a_condition_on_landed_rows_parses_a_line_once(spark, tmp_path):
    """A parser for each use of a column in a condition (9,601 for one on three columns) took more than 4 GB."""
    from eodlake.sources import documents as D
    from eodlake.sources import prices as P

    (tmp_path / "a.csv").write_text("SYMBOL,PURPOSE,EX-DATE,TIMESTAMP\nA,Bonus 1:1,05-Jan-2024,05-Jan-2024\n")
    rows, actions = P.scan(spark, str(tmp_path))[0], D.action_csv(spark, str(tmp_path), "NSE")[0]
    for df in (rows.where("exchange = 'NSE'"), rows.where("trade_date = date'2024-01-05'"), actions.where("ex_date = date'2024-01-05' and code = 'A'")):
        assert df.count() == 1
        assert df._jdf.queryExecution().optimizedPlan().toString().count("from_csv(") == 1


def test_tasks_of_the_panel_grow_in_number_with_it(spark, monkeypatch):
    monkeypatch.setattr(queries, "TASK_ROWS", 100)
    n = spark.read.parquet(f"{FOLDER}/lineitem.parquet").count()
    assert queries._one(spark, FOLDER).rdd.getNumPartitions() == -(-n // 100)


def test_tasks_of_a_rebuild_grow_in_number_with_the_panel(spark, monkeypatch):
    """Whatever its joins' other sides are dealt over; nothing is small enough to be broadcast here."""
    monkeypatch.setattr(queries, "TASK_ROWS", 100)
    for which in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.set(which, "-1")
    try:
        matched = queries._matched(spark, FOLDER)
        isins = matched.where("reconciliation_status = 'MATCHED' and adjustment_factor is not null").select("isin").distinct()
        rebuilt = queries._action_store(spark, FOLDER).rebuild(isins, matched)
        n = spark.read.parquet(f"{FOLDER}/lineitem.parquet").count()
        assert rebuilt.rdd.getNumPartitions() == -(-n // 100)
        want = queries._one(spark, FOLDER).join(isins, "isin", "left_semi").select("isin", "exchange", "trade_date")
        assert sorted(map(tuple, rebuilt.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))
    finally:
        for which in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
            spark.conf.unset(which)


def test_archives_grow_in_number_with_the_rows(spark, monkeypatch):
    made = []
    real = queries.archives.lines
    monkeypatch.setattr(queries.archives, "lines", lambda s, root: made.append(root) or real(s, root))
    monkeypatch.setattr(queries, "ARCHIVE_ROWS", 20)
    same(queries.QUERIES["src6_archives"](spark, FOLDER), connect(FOLDER), queries.ORACLES["src6_archives"])
    n = spark.read.parquet(f"{FOLDER}/events.parquet").count()
    archives = spark.read.format("binaryFile").load(made[0]).select("path").count()
    assert archives > 8 and archives >= n // 20 // 2


def test_action_files_are_as_many_as_their_rows_ask_for(spark, monkeypatch):
    """Pieces of a month follow the month's rows, not those of the whole table."""
    made = []
    real = queries.D.action_json
    monkeypatch.setattr(queries.D, "action_json", lambda s, path: made.append(path) or real(s, path))
    monkeypatch.setattr(queries, "MOST_ROWS", 100)
    same(queries.QUERIES["src5_action_json"](spark, FOLDER), connect(FOLDER), queries.ORACLES["src5_action_json"])
    a = queries.view(spark, FOLDER, "actions").groupBy("exchange", queries.F.date_format("ex_date", "yyyyMM")).count()
    files = spark.read.text(made[0]).select("_metadata.file_path").distinct().count()
    assert files <= a.select(queries.F.sum(1 + queries.F.floor(queries.F.col("count") / 100))).first()[0]


@pytest.mark.parametrize("name", ["str6_action_window", "str7_gated_enrichment"])
def test_streamed_parts_are_not_written_by_one_task(spark, monkeypatch, name):
    monkeypatch.delattr(queries.DataFrame, "coalesce")
    same(queries.QUERIES[name](spark, FOLDER), connect(FOLDER), queries.ORACLES[name])
