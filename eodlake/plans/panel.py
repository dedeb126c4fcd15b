"""Views that give the given tables the shapes of this library's inputs. One SQL text serves Spark and DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = "region nation customer supplier part orders lineitem events".split()
_DAY = "substr(cast(cast(o_orderdate as date) as string), 9, 2)"
_MONTH = "substr(cast(cast(o_orderdate as date) as string), 6, 2)"
_YEAR = "substr(cast(cast(o_orderdate as date) as string), 1, 4)"
_MMM = f"substr('JanFebMarAprMayJunJulAugSepOctNovDec', cast({_MONTH} as int) * 3 - 2, 3)"

VIEWS = {
    # daily prices: one or more rows an instrument and day, as loaded
    "prices": """
select 'S' || cast(l_suppkey as string) as isin, case when l_linestatus = 'F' then 'NSE' else 'BSE' end as exchange, l_returnflag as series,
  'P' || cast(l_partkey as string) as symbol, cast(l_shipdate as date) as trade_date, l_extendedprice as close,
  l_extendedprice * (0.95 + l_discount) as prev_close, case when l_quantity <= 2 then 0 else cast(l_quantity as bigint) end as tot_trd_qty,
  l_orderkey as row_a, l_linenumber as row_b, l_discount as row_c from {lineitem}""",
    # which series count towards an instrument's price history
    "security_series": """
select * from (values ('NSE', 'R%', 'EQUITY', true), ('NSE', 'A%', 'EQUITY', true), ('NSE', 'A_', 'DEBT', true), ('BSE', 'N%', 'EQUITY', true),
  ('BSE', 'F', 'EQUITY', false)) as t(exchange, series_code_pattern, category, include_in_price_continuity)""",
    # quotes of two exchanges over a few weeks, several a day and instrument: the carrier of daily files
    "ticks": """
select 'U' || cast(user_id as string) as isin, case when user_id % 2 = 0 then 'NSE' else 'BSE' end as exchange, 'N' as series, event_type as symbol,
  cast(ts as date) as trade_date, value as close, value * 0.9 as prev_close, event_id % 1000 as tot_trd_qty, event_id as row_a from {events}""",
    # closing values of one family of instruments, a row a day
    "daily": """
select 'U' || cast(user_id as string) as isin, 'NSE' as exchange, cast(ts as date) as trade_date, max_by(value, ts) as close from {events}
group by user_id, cast(ts as date)""",
    # what each exchange says about splits and bonuses, as text
    "actions": """
select 'S' || cast(o_custkey as string) as isin, 'P' || cast(o_custkey as string) as symbol, x.exchange, cast(o_orderdate as date) as ex_date, o_orderkey as seq,
  case when o_orderpriority = '1-URGENT' then 'Bonus ' || cast(1 + o_orderkey % 3 + case when x.exchange = 'BSE' and o_orderkey % 7 = 0 then 1 else 0 end as string) || ':1'
    when o_orderpriority = '2-HIGH' then 'Face Value Split From Rs 10/- Per Share To Rs 2/- Per Share' when o_orderpriority = '3-MEDIUM' then 'Dividend - Rs 5 Per Share'
    when o_orderpriority = '4-NOT SPECIFIED' then case when o_orderkey % 2 = 0 then 'Bonus issue' else 'Stock split' end else 'Stock split From Rs 10/- To Re 1/-' end as subject
from {orders} cross join (values ('NSE'), ('BSE')) as x(exchange)
where o_orderstatus = 'P' or (o_orderstatus = 'F') = (x.exchange = 'NSE')""",
    # one row a day and exchange with the outcome of its load
    "metadata": """
select cast(l_shipdate as date) as trade_date, case when l_linestatus = 'F' then 'NSE' else 'BSE' end as exchange,
  case when count(*) % 7 = 3 then 'FAILED' else 'SUCCESS' end as upload_status, count(*) as total_stocks, max(l_orderkey) as processing_time_ms,
  case when count(*) % 7 = 3 then 'short file' end as error_message
from {lineitem} group by cast(l_shipdate as date), case when l_linestatus = 'F' then 'NSE' else 'BSE' end""",
    # the instrument master: two to four rows an isin, by exchange family
    "universe": """
select 'S' || cast(s_suppkey as string) as isin_number, x.exchange,
  case when x.exchange like 'NSE%' and s_suppkey % 9 <> 0 then 'N' || cast(s_suppkey as string) when x.exchange like 'BSE%' then 'B' || cast(s_suppkey as string) end as symbol,
  case when x.exchange like 'BSE%' then cast(500000 + s_suppkey as string) end as security_code,
  case when s_suppkey % 13 = 0 then null when s_suppkey % 11 = 0 then 'Gold ETF ' || s_name when s_suppkey % 17 = 0 then s_name || ' Mutual Fund' else s_name end as name_of_company,
  case when s_suppkey % 3 = 0 then n_name end as sector, cast(null as string) as industry, s_acctbal as market_cap, cast(null as double) as pe
from {supplier} join {nation} on s_nationkey = n_nationkey cross join (values ('NSE', 0), ('BSE', 0), ('NSE SME', 2), ('BSE SME', 3)) as x(exchange, least)
where s_suppkey % 4 >= x.least""",
    # what three sources answer about an instrument: documents of which some lack fields, are of another shape or are no JSON
    "answers": """
select 'S' || cast(s_suppkey as string) as isin, x.source, case
  when s_suppkey % 23 = 5 then 'no answer' when s_suppkey % 23 = 7 then '[1, 2]'
  when x.source = 'NSE' then '{{"isDelisted": ' || case when s_suppkey % 19 = 0 then '"True"' when s_suppkey % 19 = 1 then 'true' else 'false' end || ', "equityResponse": ' || case when s_suppkey % 11 = 3 then '"n/a"' else
    '[{{"secInfo": {{"sector": "' || n_name || '", "industryInfo": "' || case when s_suppkey % 4 = 0 then ' ' else 'I' || cast(s_nationkey as string) end || '", "basicIndustry": "basic", "pdSymbolPe": ' ||
    case when s_suppkey % 5 = 0 then '"0.0"' when s_suppkey % 5 = 1 then '"-"' when s_suppkey % 5 = 2 then '12.5' else '"' || cast(s_suppkey % 90 + 1 as string) || '"' end ||
    ', "listingDate": "29-Nov-1995 00:00:00", "indexList": ["A", "' || n_name || '"]}}, "tradeInfo": {{"totalMarketCap": ' || cast(s_suppkey * 4 as string) || '}}}}]' end || '}}'
  when x.source = 'BSE' then '{{"IShow": "' || case when s_suppkey % 6 = 0 then ' 0' else '1' end || '", "IndustryNew": "' || n_name || '", "IGroup": "' || case when s_suppkey % 4 = 1 then '' else 'G' end || '", "ConPE": "' ||
    case when s_suppkey % 7 = 0 then '0.00' else cast(s_suppkey % 50 + 1 as string) || '.25' end || '", "PB": {{"odd": 1}}, "Index": "' || case when s_suppkey % 3 = 0 then '-' else ' top ' end || '"}}'
  else '{{' || case when s_suppkey % 5 = 0 then '' when s_suppkey % 5 = 1 then '"currentPrice": 3.5, ' else '"regularMarketPrice": 2, ' end || '"sector": "' || n_name || '", "trailingPE": ' || case when s_suppkey % 8 = 0 then '"high"' else '7.25' end ||
    ', "returnOnEquity": 0.125, "firstTradeDateMilliseconds": 820454400000, "earningsTimestamp": 820454400}}' end as doc
from {supplier} join {nation} on s_nationkey = n_nationkey cross join (values ('NSE'), ('BSE'), ('THIRD')) as x(source)""",
    # fundamentals by source tier, with gaps, placeholder zeros, infinities and values that no column holds
    "tier1": """
select 'S' || cast(s_suppkey as string) as isin, case when s_suppkey % 2 = 0 then 'NSE' else 'BSE' end as exchange, case when s_suppkey % 4 <> 0 then n_name end as sector,
  cast(null as string) as industry, case when s_suppkey % 5 = 0 then 0.0 when s_suppkey % 7 = 0 then 1e30 else s_acctbal end as market_cap,
  case when s_suppkey % 6 = 0 then cast('Infinity' as double) when s_suppkey % 10 = 1 then cast('NaN' as double) else s_acctbal / 100 end as pe,
  case when s_suppkey % 19 = 0 then 'True' when s_suppkey % 3 = 0 then null else 'false' end as delisted
from {supplier} join {nation} on s_nationkey = n_nationkey""",
    "tier2": """
select 'S' || cast(s_suppkey as string) as isin, x.exchange, 'sector ' || cast(s_nationkey as string) as sector,
  case when s_suppkey % 3 = 0 then 'industry ' || cast(s_nationkey % 4 as string) end as industry, case when s_suppkey % 2 = 0 then s_acctbal + 1 end as market_cap,
  case when s_suppkey % 8 <> 0 then s_acctbal / 50 end as pe from {supplier} cross join (values ('NSE'), ('BSE')) as x(exchange) where s_suppkey % 5 <> 4""",
    "tier3": """
select 'S' || cast(s_suppkey as string) as isin, x.exchange, 'other' as sector, 'industry other' as industry, 7.5 as market_cap, cast(s_suppkey as double) as pe
from {supplier} cross join (values ('NSE'), ('BSE')) as x(exchange) where s_suppkey % 7 <> 0""",
    # upload log of the five sources
    "uploads": """
select event_id as id, 'source' || cast(user_id % 5 as string) as data_source, case when event_id % 11 = 0 then 'failed' else 'success' end as status,
  cast(floor(value * 10) as bigint) as last_id from {events}""",
    # stored RSI rows of earlier days
    "stored": """
select isin, exchange, trade_date, max(close) as avg_gain, min(close) as avg_loss, count(*) as n from (
  select 'S' || cast(l_suppkey as string) as isin, case when l_linestatus = 'F' then 'NSE' else 'BSE' end as exchange, cast(l_shipdate as date) as trade_date,
    l_extendedprice as close from {lineitem}) as x group by isin, exchange, trade_date""",
    # raw texts of a file: numbers and dates as strings, some of them junk
    "raw": f"""
select o_orderkey as id, case o_orderkey % 6 when 0 then ' ' when 1 then null else ' ' || o_orderstatus end as primary_text, o_orderpriority as other_text,
  case o_orderkey % 7 when 0 then {_DAY} || '-' || {_MMM} || '-' || {_YEAR} when 1 then {_YEAR} || '-' || {_MONTH} || '-' || {_DAY}
    when 2 then {_DAY} || '/' || {_MONTH} || '/' || {_YEAR} when 3 then cast(cast({_DAY} as int) as string) || '-' || {_MMM} || '-' || {_YEAR}
    when 4 then 'n/a' when 5 then {_DAY} || '-' || {_MONTH} || '-' || {_YEAR}
    else case when o_orderkey % 2 = 0 then {_MONTH} || '/' || {_DAY} || '/' || {_YEAR} when o_orderkey % 5 > 0 then {_DAY} || '-' || {_MMM} || '-' || substr({_YEAR}, 3, 2) end end as date_text,
  case o_orderkey % 5 when 0 then ' ' || cast(o_totalprice as string) when 1 then '-' when 2 then '' when 3 then cast(o_custkey as string) || '.125' else cast(o_custkey as string) || '.00' end as number_text,
  case when o_orderkey % 4 = 0 then cast(o_custkey as string) || '.00' when o_orderkey % 4 = 1 then cast(o_custkey as string) when o_orderkey % 4 = 2 then 'x' end as int_text,
  cast(o_orderdate as date) as day, o_orderkey % 100000 * 86400 as epoch_s, o_orderkey % 100000 * 86400000 as epoch_ms, o_totalprice as price, o_custkey as cust
from {{orders}}""",
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of ``VIEWS`` over the tables of ``sf_dir``."""
    text = VIEWS[name]
    used = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if "{" + t + "}" in text}
    return spark.sql(text, **used)


def sql(body: str) -> str:
    """DuckDB SQL of ``body``, with the views that it names in front."""
    names = [n for n in VIEWS if f" {n} " in f" {body} ".replace("\n", " ").replace(",", " ").replace(")", " ").replace("(", " ")]
    ctes = ", ".join(f"{n} AS ({VIEWS[n].format(**{t: t for t in TABLES})})" for n in names)
    body = body.strip()
    if body.upper().startswith("WITH RECURSIVE"):
        return f"WITH RECURSIVE {ctes}, {body[14:]}"
    if body.upper().startswith("WITH "):
        return f"WITH {ctes}, {body[5:]}" if ctes else body
    return f"WITH {ctes} {body}" if ctes else body
