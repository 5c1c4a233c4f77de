"""Queries of the streaming jobs, run over the tables as streams that stop when all is read (family T)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrane.operators import aggregates as A
from terrane.operators.graph import scratch
from terrane.plans.base import Book, Tables
from terrane.plans.q_joins import _PROBE
from terrane.streaming import jobs as T

book = Book()
add = book.add
QUERIES, ORACLE_SQL = book.queries, book.sql


def arriving(t: Tables, table: str) -> tuple[DataFrame, str]:
    """A table as a stream of its files, and a folder of this query's own."""
    path = f"{t.sf_dir}/{table}.parquet"
    source = t.spark.read.parquet(path)
    single = source.inputFiles()[0].endswith(f"/{table}.parquet")  # one file, or a folder of them
    reader = t.spark.readStream.schema(source.schema).option("pathGlobFilter", f"{table}.parquet" if single else "*.parquet")
    return reader.parquet(t.sf_dir if single else path), scratch(source)


def drained(stream: DataFrame, home: str, mode: str) -> DataFrame:
    """What a stream gives until all is read; batches are appended by foreachBatch to a table, in update mode the last row of each key counts."""
    write = lambda df, n: df.withColumn("_batch", F.lit(n)).write.mode("append").parquet(f"{home}/out")
    with T.keyed_state(stream.sparkSession):
        stream.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", f"{home}/state").trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.read.parquet(f"{home}/out")


def streamed(t: Tables, table: str, build, mode: str) -> DataFrame:
    """The result of a streaming query over a table, read to its end by available-now triggers."""
    stream, home = arriving(t, table)
    return drained(build(stream), home, mode)


_METRIC = "user_id as api_key", "cast(ts as timestamp) as ts", "cast(floor(value * 1000) as bigint) as bytes"
_last = lambda df, *keys: df.groupBy(*keys).agg(F.max_by(F.struct(*[c for c in df.columns if c not in (*keys, "_batch")]), "_batch").alias("r")).select(*keys, "r.*")
add("t1_usage_stream", lambda t: _last(streamed(t, "events", lambda s: T.usage_stream(s.selectExpr(*_METRIC)), "update"), "api_key", "month"), "select user_id api_key, strftime(ts, '%Y-%m') as month, cast(sum(cast(floor(value * 1000) as bigint)) as bigint) bytes, count(*) requests from events group by 1, 2")
_USAGE = lambda t: _last(streamed(t, "events", lambda s: T.usage_stream(s.selectExpr(*_METRIC)), "update"), "api_key", "month")
add("t1_usage_state", lambda t: A.cap_state(_USAGE(t), t.events.selectExpr("user_id as api_key", "100000 + user_id * 1000 as cap").distinct()).select("api_key", "month", "state", "percent"), "select api_key, month, case when bytes >= cap then 'hard' when bytes >= 8e-1 * cap then 'soft' else 'ok' end state, round(bytes / cap * 100e0, 1) as percent from (select user_id api_key, 100000 + user_id * 1000 cap, strftime(ts, '%Y-%m') as month, cast(sum(cast(floor(value * 1000) as bigint)) as double) bytes from events group by 1, 2, 3)")
add("t2_anonymous_rates", lambda t: _last(streamed(t, "events", lambda s: T.anonymous_rates(s.selectExpr("cast(ts as timestamp) ts", "event_type as client"), 1), "update"), "client", "minute").select("client", F.date_format("minute", "yyyy-MM-dd HH:mm").alias("minute"), "n"), "select event_type client, strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M') as minute, count(*) n from events group by 1, 2 having count(*) > 1")
_STATUS = lambda t: T.status_now(streamed(t, "events", lambda s: T.status_stream(s.selectExpr("user_id as key", "cast(cast(ts as date) as string) as date", "event_id as seq", "event_type as value")), "append")).withColumn("key", F.col("key").cast("bigint"))
add("t3_status_stream", lambda t: _STATUS(t).withColumn("history", F.array_join(F.transform("history", lambda e: F.concat_ws(" ", e["date"], e["value"])), ",")), "select user_id as key, max(strftime(ts, '%Y-%m-%d')) as date, arg_max(event_type, strftime(ts, '%Y-%m-%d') || lpad(cast(event_id as varchar), 20, '0')) as value, string_agg(strftime(ts, '%Y-%m-%d') || ' ' || event_type, ',' order by cast(ts as date), event_id) history, count(*) as events from events group by 1")


def _changes(t: Tables) -> DataFrame:
    """Probes arrive in three files, each with some of a slug's sources, one file a batch; every 97th failed."""
    number = F.col("source_no")
    probes = _PROBE(t, True).withColumn("error", F.when(number % 97 == 0, F.lit("timeout"))).withColumn("sources", F.count("*").over(Window.partitionBy("slug")))
    home = scratch(probes)
    probes.repartitionByRange(3, F.pmod(number, F.lit(3))).write.parquet(f"{home}/probes")
    stream = t.spark.readStream.schema(probes.schema).option("maxFilesPerTrigger", 1).parquet(f"{home}/probes")
    T.change_stream(stream, _PROBE(t, False), f"{home}/changes", f"{home}/state", once=True).awaitTermination()
    return t.spark.read.parquet(f"{home}/changes").drop("batch")


add("t4_change_stream", _changes, """with good as (select * from supplier where s_suppkey % 13 <> 0 and s_nationkey not in (select s_nationkey from supplier where s_suppkey % 13 <> 0 and s_suppkey % 97 = 0)), old as (select * from supplier where s_suppkey % 11 <> 0 and s_nationkey in (select s_nationkey from good)),
r as (select cast(coalesce(o.s_nationkey, g.s_nationkey) as varchar) slug, coalesce(o.s_suppkey, g.s_suppkey) source_no, case when o.s_suppkey is null then 'new source' when g.s_suppkey is null then 'source gone'
  when g.s_suppkey % 3 = 0 then case when g.s_suppkey % 2 <> 0 then 'last edit' when g.s_suppkey % 9 = 0 then 'count' end when g.s_suppkey % 3 = 1 then case when g.s_suppkey % 5 <> 1 then 'checksum' end when g.s_suppkey % 7 <> 2 then 'validators' end reason
  from old o full join good g on o.s_suppkey = g.s_suppkey)
select slug, min(source_no) source_no, arg_min(reason, source_no) reason from r where reason is not null group by slug
union all select cast(s_nationkey as varchar), s_suppkey, 'failed: timeout' from supplier where s_suppkey % 13 <> 0 and s_suppkey % 97 = 0""")


def _pages(t: Tables) -> DataFrame:
    """Features written as page files, an id in several of them, and read as they arrive."""
    home = scratch(t.orders)
    t.orders.select((F.col("o_orderkey") % 5000).alias("id"), F.to_timestamp(F.lit("2024-01-01")).alias("ts")).write.json(f"{home}/pages")
    return drained(T.feature_pages_stream(t.spark, f"{home}/pages", "id long, ts timestamp"), home, "append").select("id")


add("t5_feature_pages", _pages, "select distinct o_orderkey % 5000 id from orders")
