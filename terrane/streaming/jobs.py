"""Streaming forms of the periodic jobs. Each takes a streaming or a batch DataFrame, so the batch run is its own check.

Jobs with state of their own (:func:`status_stream`, :func:`change_stream`) keep it by key in RocksDB, which
:func:`keyed_state` asks the session for while they start.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from terrane.operators.joins import detect_changes

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def keyed_state(spark: SparkSession):
    """Streams that start within keep their state in RocksDB, where a key's entries are read and written one by one."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before) if before else spark.conf.unset(_PROVIDER)


def usage_stream(metrics: DataFrame, late: str = "2 hours") -> DataFrame:
    """Bytes and requests per key and month (update mode for running totals, append mode for each month once it is closed).

    The event time is the end of a request's month, so a month is a group of one event time and closes when the watermark
    passes it. The watermark stays 31 days and ``late`` behind the end of the newest month: requests may be late by
    that much, and when the month after next begins a month's state is dropped. State thus holds two months of each
    key, however long the stream runs. Sums are partial in each task, so a key with most of the requests is no task's own.
    """
    end = F.date_trunc("month", F.add_months(F.date_trunc("month", "ts"), 1))
    d = metrics.where("api_key is not null").withColumn("month_end", end).withWatermark("month_end", f"31 days {late}")
    totals = d.groupBy("api_key", "month_end").agg(F.sum("bytes").alias("bytes"), F.count("*").alias("requests"))
    return totals.select("api_key", F.date_format(F.col("month_end") - F.expr("interval 1 day"), "yyyy-MM").alias("month"), "bytes", "requests")


def anonymous_rates(requests: DataFrame, limit: int, late: str = "5 minutes") -> DataFrame:
    """Clients over the limit in a minute (append mode)."""
    d = requests.withWatermark("ts", late).groupBy(F.window("ts", "1 minute"), "client").agg(F.count("*").alias("n"))
    return d.where(F.col("n") > limit).select("client", F.col("window.start").alias("minute"), "n")


class _StatusLog(StatefulProcessor):
    """Per key: the events met, as a map by (date, seq), and the latest of them with their number."""

    def init(self, handle) -> None:
        self.met = handle.getMapState("met", "date string, seq long", "value string")
        self.latest = handle.getValueState("latest", "date string, seq long, value string, events long")

    def handleInputRows(self, key, rows, timerValues):
        latest = tuple(self.latest.get()) if self.latest.exists() else None
        for r in rows:
            place = (r["date"], r["seq"])
            if latest and place <= latest[:2] and self.met.containsKey(place):  # what is later than all others is new
                continue
            self.met.updateValue(place, (r["value"],))
            number = latest[3] + 1 if latest else 1
            latest = (*place, r["value"], number) if latest is None or place > latest[:2] else (*latest[:3], number)
            yield Row(key=key[0], date=r["date"], seq=r["seq"], value=r["value"], latest_date=latest[0], latest_seq=latest[1], latest_value=latest[2], events=number)
        if latest:
            self.latest.update(latest)

    def close(self) -> None:
        pass


def status_stream(events: DataFrame) -> DataFrame:
    """The log of status events as they are accepted (append mode). ``events`` has (key, date, seq, value), none of the first three null.

    Each event gives one row: itself, the key's latest status with it, and the number of the key's events so far. An event
    that comes again, with the same (key, date, seq), gives none. An event reads and writes its own entry and the latest one,
    whatever the key has gone through before; nothing is kept as one growing value. :func:`status_now` turns the log to a table.
    """
    typed = events.select(F.col("key").cast("string").alias("key"), F.col("date").cast("string").alias("date"), F.col("seq").cast("long").alias("seq"), F.col("value").cast("string").alias("value"))
    shape = "key string, date string, seq long, value string, latest_date string, latest_seq long, latest_value string, events long"
    return typed.groupBy("key").transformWithState(_StatusLog(), shape, "Append", "None")


def status_now(log: DataFrame) -> DataFrame:
    """(key, date, value, history, events) per key: current status, ordered history and number of events. ``log`` has (key, date, seq, value): the events, or what :func:`status_stream` made of them."""
    step = F.struct("date", "seq", "value")
    each = log.select("key", "date", "seq", "value").dropDuplicates(["key", "date", "seq"])
    d = each.groupBy("key").agg(F.max(step).alias("latest"), F.array_sort(F.collect_list(step)).alias("history"), F.count("*").alias("events"))
    return d.select("key", "latest.date", "latest.value", "history", "events")


class _Held(StatefulProcessor):
    """Per slug: the probes of its run that have come, by source; they go on when all have come, or when the watermark is past their wait."""

    def __init__(self, shape: T.StructType, at: str | None, wait_ms: int):
        self.shape, self.at, self.wait_ms = shape, at, wait_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.come = handle.getMapState("come", "source_no long", self.shape)
        self.count = handle.getValueState("count", "n long, timer long")

    def _given(self, slug: str, complete: bool):
        for (source,), probe in self.come.iterator():
            yield Row(slug=slug, source_no=source, **dict(zip(self.shape.names, probe, strict=True)), complete=complete)
        self.come.clear()
        self.count.clear()

    def handleInputRows(self, key, rows, timerValues):
        n, timer = tuple(self.count.get()) if self.count.exists() else (0, 0)
        wanted = 0
        for r in rows:
            if self.at and not timer:
                timer = int(r[self.at].timestamp() * 1000) + self.wait_ms
                self.handle.registerTimer(timer)
            n += not self.come.containsKey((r["source_no"],))
            self.come.updateValue((r["source_no"],), tuple(r[c] for c in self.shape.names))
            wanted = max(wanted, r["sources"])
        if n < wanted:
            self.count.update((n, timer))
            return
        if timer:
            self.handle.deleteTimer(timer)
        yield from self._given(key[0], True)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        yield from self._given(key[0], False)

    def close(self) -> None:
        pass


def complete_runs(probes: DataFrame, at: str | None = None, wait_seconds: int = 3_600) -> DataFrame:
    """Probes (slug, source_no, sources, ...) of a slug together, once all ``sources`` of its run have come (append mode).

    ``sources`` is how many sources the run probes for the slug. A source probed again before that counts as last probed. With
    ``at``, a column of timestamps, a run that is not complete goes on with ``complete`` false when probes come that are
    ``wait_seconds`` later than its first one; without, it waits.
    """
    given = probes.withColumn("slug", F.col("slug").cast("string")).withColumn("source_no", F.col("source_no").cast("long")).withColumn("sources", F.col("sources").cast("long"))
    fields = [f for f in given.schema.fields if f.name not in ("slug", "source_no")]
    shape = T.StructType([T.StructField(f.name, f.dataType) for f in fields])
    out = T.StructType([T.StructField("slug", T.StringType()), T.StructField("source_no", T.LongType()), *shape.fields, T.StructField("complete", T.BooleanType())])
    timed = given.withWatermark(at, "0 seconds") if at else given
    return timed.groupBy("slug").transformWithState(_Held(shape, at, wait_seconds * 1000), out, "Append", "EventTime" if at else "None")


def probed_changes(published: DataFrame, probes: DataFrame) -> DataFrame:
    """(slug, source_no, reason) of probed slugs: the first changed source, or each failed probe.

    A slug with a failed probe is not compared, since its source is not gone; nor is one whose run came incomplete.
    """
    failed = probes.where("error is not null").select("slug", "source_no", F.concat(F.lit("failed: "), "error").alias("reason"))
    short = probes.where("not complete").groupBy("slug").agg(F.min("source_no").alias("source_no")).withColumn("reason", F.lit("incomplete"))
    out = failed.select("slug").union(short.select("slug")).distinct()
    whole = probes.join(out, "slug", "left_anti")
    known = published.join(whole.select("slug").distinct(), "slug", "left_semi")
    return detect_changes(known, whole).unionByName(failed).unionByName(short.join(failed.select("slug"), "slug", "left_anti"))


def change_stream(probes: DataFrame, published: DataFrame, target: str, checkpoint: str, once: bool = False, at: str | None = None, wait_seconds: int = 3_600):
    """Compares arriving probes with the published tokens (J-17), each slug once all of its sources have come, and writes what changed to ``target``.

    Each batch owns the folder ``batch=N`` of the target and overwrites it, so a batch that runs again after a failure adds
    nothing. A probe that failed has an ``error`` and becomes a row of its own; it never stops the others. Probes without
    ``sources`` are held until as many have come as the slug has published, or one of a new slug; only a number tells that a source is gone. With
    ``once`` the stream ends when all that has arrived is read.
    """
    if "sources" not in probes.columns:
        known = published.groupBy("slug").agg(F.count("*").alias("sources"))
        probes = probes.join(known, "slug", "left").withColumn("sources", F.coalesce("sources", F.lit(1)))

    def batch(df: DataFrame, number: int) -> None:
        df = df.persist()
        try:
            probed_changes(published, df).write.mode("overwrite").parquet(f"{target}/batch={number}")
        finally:
            df.unpersist()

    with keyed_state(probes.sparkSession):
        writer = complete_runs(probes, at, wait_seconds).writeStream.outputMode("append").foreachBatch(batch).option("checkpointLocation", checkpoint)
        return (writer.trigger(availableNow=True) if once else writer).start()


def feature_pages_stream(spark, path: str, schema: str, late: str = "1 day") -> DataFrame:
    """Features of page files as they arrive, each id once. ``schema`` has id and ts."""
    d = spark.readStream.schema(schema).json(path)
    return d.withWatermark("ts", late).dropDuplicatesWithinWatermark(["id"])
