import datetime
import zipfile

from pyspark.sql import functions as F

from eodlake.functions import columns as C
from eodlake.operators import actions as A
from eodlake.operators import calendars as K
from eodlake.sources import archives
from eodlake.sources import documents as D
from eodlake.sources import prices as P
from eodlake.sources.lines import first_lines

V2 = "TradDt,BizDt,Src,ISIN,TckrSymb,SctySrs,OpnPric,HghPric,LwPric,ClsPric,LastPric,PrvsClsgPric,TtlTradgVol,TtlTrfVal,TtlNbOfTxsExctd\n"
V1 = "SYMBOL,SERIES,OPEN,HIGH,LOW,CLOSE,LAST,PREVCLOSE,TOTTRDQTY,TOTTRDVAL,TIMESTAMP,TOTALTRADES,ISIN,\n"
V3 = "isin,tckrsymb,SCTYSRS,OpnPric,HghPric,LwPric,ClsPric,LastPric,PrvsClsgPric,TtlTradgVol,TtlTrfVal,TradDt,TtlNbOfTxsExctd\n"


def files(folder):
    (folder / "NSE-BC-05-JAN-2024.csv").write_text(V2 + "2024-01-05,2024-01-05,NSE,INE1,AAA,EQ,1,2,0.5,10.005,1,8.00,3490.00,5,7\n2024-01-05,2024-01-05,NSE,INE1,AAA,BL,1,2,0.5,11,1,,12,5,7\n2024-01-05,2024-01-05,NSE,INE1,AAA,EQ,1,2,0.5,99,1,8,1,5,7\n2024-01-05,x,NSE,INE2,BBB,EQ, ,-,junk,4,1,0,,5,\n")
    (folder / "NSE-BC-14-DEC-2023.csv").write_text("﻿" + V1 + "AAA,EQ,1,2,1,12.5,1,12,100,9,14-DEC-2023,3,INE1,\n")
    (folder / "BSE-BC-14-DEC-2023.csv").write_text(V3 + "INE3,CCC,A,1,2,1,5,1,4,3490.00,9,2023-12-14,2\n")
    (folder / "BSE-BC-15-DEC-2023.csv").write_text(V3 + "INE3,CCC,A,1,2,1,5,1,4,10,9,2023-12-14,2\n")
    (folder / "BSE-BC-16-DEC-2023.csv").write_text("")
    (folder / "BSE-BC-17-DEC-2023.csv").write_text("<html>not found</html>")


def test_three_layouts(spark, tmp_path):
    files(tmp_path)
    rows, rejects = P.scan(spark, str(tmp_path))
    # an empty file may give no row at all
    assert "BSE-BC-17-DEC-2023.csv" in {r.file.rsplit("/", 1)[1] for r in rejects.collect()} <= {"BSE-BC-16-DEC-2023.csv", "BSE-BC-17-DEC-2023.csv"}
    rows = P.first_in_file(rows)
    got = {(r.exchange, r.symbol, r.series, str(r.trade_date)): r for r in rows.collect()}
    assert len(got) == 5 and rows.count() == 6  # the misdated file repeats a key of another file
    first = got["NSE", "AAA", "EQ", "2024-01-05"]
    assert str(first.close) == "10.01" and first.tot_trd_qty == 3490 and float(first.ltp_percent_change) == 25.125
    assert got["NSE", "AAA", "BL", "2024-01-05"].ltp_percent_change is None
    assert got["NSE", "BBB", "EQ", "2024-01-05"].open is None and got["NSE", "BBB", "EQ", "2024-01-05"].ltp_percent_change is None
    assert got["NSE", "AAA", "EQ", "2023-12-14"].isin == "INE1"
    assert {r.tot_trd_qty for r in rows.where("exchange = 'BSE'").collect()} == {3490, 10}
    wrong = [r.file.rsplit("/", 1)[1] for r in P.misdated(rows, P.file_facts(F.col("file"))[1]).collect()]
    assert wrong == ["BSE-BC-15-DEC-2023.csv"]


def test_rows_of_one_layout(spark):
    """The layout of all rows by its name gives what a column of it gives."""
    v1 = spark.createDataFrame([("AAA", "12.5", "14-DEC-2023", "3490.00")], "symbol string, CLOSE string, TIMESTAMP string, TOTTRDQTY string")
    other = spark.createDataFrame([("CCC", "5", "2023-12-14", "10", "MSE")], "TckrSymb string, ClsPric string, TradDt string, TtlTradgVol string, Src string")
    for rows, layout, want in ((v1, "v1", ("NSE", "AAA", "12.50", 3490)), (other, "v2", ("MSE", "CCC", "5.00", 10)), (other, "v3", ("BSE", "CCC", "5.00", 10))):
        got = P.project(rows, layout).collect()
        assert [(r.exchange, r.symbol, str(r.close), r.tot_trd_qty, str(r.trade_date), r.total_trades) for r in got] == [(*want, "2023-12-14", None)]
        assert got == P.project(rows.withColumn("layout", F.lit(layout)), F.col("layout")).collect()


def test_no_files_of_any_layout(spark, tmp_path):
    (tmp_path / "a.csv").write_text("one,two\n1,2\n")
    rows, rejects = P.scan(spark, str(tmp_path))
    assert rows.count() == 0 and rejects.count() == 1 and "ltp_percent_change" in rows.columns


def test_archives(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("note.txt", "no")
        z.writestr("x.CSV", "﻿a,b\n1,2\n")
    (tmp_path / "b.zip").write_text("<HTML>no</HTML>")
    (tmp_path / "c.zip").write_text("")
    (tmp_path / "d.zip").write_text("neither")
    got = sorted((r.file.rsplit("/", 2)[1:], r.at, r.value) for r in archives.lines(spark, str(tmp_path)).collect())
    assert got == [(["a.zip", "x.CSV"], 0, "a,b"), (["a.zip", "x.CSV"], 1, "1,2")]
    (tmp_path / "none").mkdir()
    assert archives.lines(spark, str(tmp_path / "none")).count() == 0


def test_rows_that_differ_by_group_sums(spark):
    from eodlake.operators import tables as T

    schema = "g string, k int, v double"
    a = spark.createDataFrame([("a", 1, 1.0), ("a", 2, None), ("b", 1, 1.0), ("b", 2, 2.0), ("c", 1, 1.0)], schema)
    b = spark.createDataFrame([("a", 2, None), ("a", 1, 1.0), ("b", 1, 1.5), ("b", 3, 2.0), ("d", 1, None)], schema)
    got = sorted(map(tuple, T.different(a, b, ["g"], ["g", "k"], ["v"]).collect()))
    assert got == [("b", 1, 1.0, 1.5), ("b", 2, 2.0, None), ("b", 3, None, 2.0), ("c", 1, 1.0, None), ("d", 1, None, None)]
    assert T.different(a, a, ["g"], ["g", "k"], ["v"]).count() == 0


def test_action_files(spark, tmp_path):
    a = tmp_path / "a"
    a.mkdir()
    (a / "1.csv").write_text("symbol,Purpose,Ex-Date\naaa,Bonus 1:1,05-Jan-2024\nbbb,Face Value Split From Rs 10/- Per Share To Re 1/- Per Share,5-Jan-2024\nccc,Dividend - Rs 5,05-Jan-2024\nddd,Stock split,06-01-2024\n")
    (a / "2.csv").write_text("{}")
    (a / "3.csv").write_text("")
    rows, rejects = D.action_csv(spark, str(a), "NSE")
    parsed = {r.code: r for r in A.parsed(rows.withColumnRenamed("symbol", "s")).collect()}
    assert set(parsed) == {"AAA", "BBB", "DDD"} and rejects.count() >= 1
    assert (parsed["AAA"].face_value_old, parsed["AAA"].face_value_new) == (2, 1)
    assert (parsed["BBB"].face_value_old, parsed["BBB"].face_value_new) == (10, 1)
    assert parsed["DDD"].face_value_old is None and parsed["DDD"].ex_date == datetime.date(2024, 1, 6)
    j = tmp_path / "j"
    j.mkdir()
    (j / "1.json").write_text('[{"isin": "I1", "symbol": "AAA", "subject": "Bonus 1:2", "exDate": "05-Jan-2024"}]')
    (j / "2.json").write_text('{"Table": [{"scrip_code": "5", "short_name": "B", "Purpose": "Bonus issue", "Ex_date": "10 Aug 2026"}]}')
    got = sorted((r.exchange, r.symbol, str(r.ex_date)) for r in D.action_json(spark, str(j)).collect())
    assert got == [("BSE", "B", "2026-08-10"), ("NSE", "AAA", "2024-01-05")]


def test_first_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text("\ufeffx,y\n1,2\n")
    (tmp_path / "b.csv").write_text("\n \n  {\n")
    (tmp_path / "c.csv").write_text("\n\n")
    got = {r.file.rsplit("/", 1)[1]: (r.header, r.shown) for r in first_lines(spark, str(tmp_path)).collect()}
    assert got == {"a.csv": ("x,y", "x,y"), "b.csv": ("", "  {"), "c.csv": ("", None)}
    rows, rejects = D.action_csv(spark, str(tmp_path), "NSE")
    assert rows.count() == 1 and {r.file.rsplit("/", 1)[1] for r in rejects.collect()} == {"b.csv", "c.csv"}


def test_action_files_of_other_columns(spark, tmp_path):
    (tmp_path / "a.csv").write_text('\n"Ex Date","Purpose","Security Code"\n05 Jan 2024,"Bonus, 1:1",500\n\n')
    (tmp_path / "b.csv").write_text("\ufeffSecurity Code ,x,EX DATE\n501,y,06 Jan 2024\n502\n")
    rows, rejects = D.action_csv(spark, str(tmp_path), "BSE")
    got = sorted((r.code, r.subject, str(r.ex_date)) for r in rows.collect())
    assert got == [("500", "Bonus, 1:1", "2024-01-05"), ("501", None, "2024-01-06"), ("502", None, "None")] and rejects.count() == 0


def test_files_of_many_splits(spark, tmp_path):
    (tmp_path / "NSE-BC-14-DEC-2023.csv").write_text(V1 + "".join(f"S{i},EQ,1,2,1,12.5,1,12,{i},9,14-DEC-2023,3,INE{i},\n" for i in range(3000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        rows, rejects = P.scan(spark, str(tmp_path))
        assert rejects.count() == 0 and sorted(r.tot_trd_qty for r in rows.collect()) == list(range(3000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_json_that_is_none(spark, tmp_path):
    (tmp_path / "1.json").write_text("<html>no</html>")
    (tmp_path / "2.json").write_text('{"message": "blocked"}')
    (tmp_path / "3.json").write_text("")
    (tmp_path / "4.json").write_text('{"Table": []}')
    (tmp_path / "5.json").write_text('[{"isin": "I1", "symbol": "AAA", "subject": "x", "exDate": "05-Jan-2024"},\n {"isin": "I2"}]')
    assert sorted(r.isin for r in D.action_json(spark, str(tmp_path)).collect()) == ["I1", "I2"]


def test_fundamentals(spark):
    docs = spark.createDataFrame(
        [
            (1, "NSE", '{"equityResponse": [{"secInfo": {"sector": "IT", "industryInfo": " ", "basicIndustry": "Soft", "pdSymbolPe": "0.0", "listingDate": "29-Nov-1995 00:00:00", "indexList": ["A"]}, "tradeInfo": {"totalMarketCap": 5.0}}]}'),
            (2, "NSE", '{"isDelisted": "True"}'),
            (3, "BSE", '{"IShow": "1", "IndustryNew": "IT", "PB": "2.5", "ROE": "0.0", "Index": "-"}'),
            (4, "BSE", '{"IShow": "0"}'),
            (5, "THIRD", '{"currentPrice": 3.5, "returnOnEquity": 0.25, "firstTradeDateMilliseconds": 86400000}'),
            (6, "THIRD", "{}"),
        ],
        "id int, source string, doc string",
    )
    (a,) = D.fundamentals(docs.where("source = 'NSE'"), "NSE").collect()
    assert (a.industry, a.price_to_earnings_ratio, str(a.date_of_listing), a.index_list) == ("Soft", None, "1995-11-29", ["A"])
    (b,) = D.fundamentals(docs.where("source = 'BSE'"), "BSE").collect()
    assert (b.price_to_book_ratio, b.return_on_equity, b.index_list) == (2.5, None, None)
    (c,) = D.fundamentals(docs.where("source = 'THIRD'"), "THIRD").collect()
    assert (c.return_on_equity, str(c.date_of_listing)) == (25.0, "1970-01-02")


def test_parsing(spark):
    df = spark.createDataFrame([("05-Jan-75", "3490.00", "2.345"), ("5/1/2024", "x", "-"), (" ", "", None)], "d string, n string, p string")
    got = df.select(C.parse_date(F.col("d")), C.parse_int(F.col("n")), C.parse_decimal(F.col("p"))).collect()
    assert [str(r[0]) for r in got] == ["1975-01-05", "2024-01-05", "None"]
    assert [r[1] for r in got] == [3490, None, None] and [str(r[2]) for r in got] == ["2.35", "None", "None"]


def test_months_by_their_names(spark):
    """Full names, and formats with letters other than those of days; what doesn't fit gives no day, and a day comes once."""
    texts = ["January 26, 2026", "May 5, 2024", "may 05, 2024", " August 15, 1995 ", "2024-05-05", "Smarch 1, 2024", "February 30, 2024", "", None]
    rows = spark.createDataFrame([(t,) for t in texts], "date string")
    assert sorted(str(r.day) for r in K.holidays(rows).collect()) == ["1995-08-15", "2024-05-05", "2026-01-26"]
    other = rows.limit(1).select(C.parse_date(F.lit("26. January 2026"), ("d. MMMM yyyy",)), C.parse_date(F.lit("5 PM 05/01/2024"), ("h a dd/MM/yyyy",)))
    assert list(map(str, other.first())) == ["2026-01-26", "2024-01-05"]


def test_reconciliation(spark):
    raw = spark.createDataFrame(
        [("I1", "BONUS", "NSE", "A", "2", "1"), ("I1", "BONUS", "BSE", "A", "2", "1"), ("I2", "BONUS", "NSE", "B", "2", "1"), ("I2", "BONUS", "BSE", "B", "3", "1"), ("I3", "SPLIT", "NSE", "C", None, None), ("I3", "SPLIT", "BSE", None, "10", "2"), ("I4", "SPLIT", "BSE", "D", "10", "0")],
        "isin string, action_type string, exchange string, symbol string, o string, n string",
    ).selectExpr("isin", "action_type", "exchange", "symbol", "date'2024-01-05' as ex_date", "cast(o as decimal(20,6)) face_value_old", "cast(n as decimal(20,6)) face_value_new")
    got = {r.isin: (r.reconciliation_status, None if r.adjustment_factor is None else float(r.adjustment_factor)) for r in A.reconciled(raw).collect()}
    assert got == {"I1": ("MATCHED", 0.5), "I2": ("CONFLICT", None), "I3": ("MATCHED", 0.2), "I4": ("BSE_ONLY", 0.0)}


def test_continuity(spark):
    loads = spark.sql("select * from values ('NSE', 'SUCCESS', date'2024-01-03'), ('BSE', 'FAILED', date'2024-01-03') as t(exchange, upload_status, trade_date)")
    days = spark.sql("select explode(sequence(date'2024-01-01', date'2024-01-05')) as trade_date")
    got = {r.exchange: r for r in K.continuity(loads, days, F.lit("2024-01-04").cast("date")).collect()}
    assert got["NSE"].outcome == "DUE" and got["NSE"].pending_dates == "04-Jan-2024" and got["BSE"].outcome == "NO_HISTORY"
