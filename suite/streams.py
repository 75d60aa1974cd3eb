"""Checks that run streams over the given tables and compare what they leave behind."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from rollcall.operators.joins import in_window, join_regtype
from rollcall.operators.windows import flat_window, tumbling_counts
from rollcall.plans import ods
from rollcall.plans.member_wide import wide_table
from rollcall.schemas import DIMENSION_TOPICS, FACT_TOPICS
from rollcall.session import fresh_dir
from rollcall.sinks.upsert_table import UpsertTable
from rollcall.sources import member_records, payment_records, read_lines, read_raw_log, regtype_records
from rollcall.streaming import jobs
from rollcall.streaming.arrival import arrival_sessions
from rollcall.streaming.early import early_changes, early_table, standing, start_early_table
from rollcall.streaming.event_time import fact_time, member_time
from rollcall.streaming.grouped import cogroup_stream
from rollcall.streaming.running import RunningCount, start_running_count
from rollcall.streaming.ttl_state import last_logins

from . import views
from .joins import JN2, JN6, MERGED, PAIR_ORDER, STORED, WIDE, jn1_sql, last_values_sql
from .registry import check
from .sources_sinks import _latest_sql
from .transforms import session_sql
from .views import DAY, names

_DAY_US = 86_400_000_000
# A time in the middle of the events, at the border of two days.
_CUT = "TIMESTAMP '2024-01-15 00:00:00'"
_CUT_US = 1_705_276_800_000_000

_SPACE_WORDS = r"""
WITH l AS (SELECT unnest(string_split(replace(text, chr(13), chr(10)), chr(10))) AS line FROM documents),
w AS (SELECT unnest(string_split(rtrim(line, ' '), ' ')) AS word FROM l WHERE line = '' OR rtrim(line, ' ') <> '')
SELECT word, count(*) AS n FROM w GROUP BY word"""


def _counts_table(spark: SparkSession) -> UpsertTable:
    return UpsertTable(spark, fresh_dir(spark, "counts"), jobs.WORD_COUNTS, ["word"])


@check("agg1_running_counts", _SPACE_WORDS)
def agg1(spark, sf_dir):
    """Running counts in update mode; the table ends up with the last of each word."""
    folder = fresh_dir(spark, "lines")
    views.lines(spark, sf_dir).select("line").write.text(folder)
    counts = _counts_table(spark)
    jobs.start_word_count(read_lines(spark, folder), counts, fresh_dir(spark, "cp"), poison=None).awaitTermination()
    return counts.read()


@check("str12_resumed_counts", _SPACE_WORDS)
def str12(spark, sf_dir):
    """The same in two runs on one checkpoint, with half of the lines arriving in between."""
    folder, checkpoint = fresh_dir(spark, "lines"), fresh_dir(spark, "cp")
    counts = _counts_table(spark)
    lines = views.lines(spark, sf_dir).select("line", (F.xxhash64("line") > 0).alias("late"))
    for late in (False, True):
        lines.where(F.col("late") == late).select("line").write.mode("append").text(folder)
        jobs.start_word_count(read_lines(spark, folder), counts, checkpoint, poison=None).awaitTermination()
    return counts.read()


@check("src5_from_earliest", "SELECT topic, count(*) AS n FROM (SELECT CASE event_type WHEN 'signup' THEN 'member' "
       "WHEN 'click' THEN 'memberregtype' ELSE 'memberpaymoney' END AS topic FROM ev "
       "WHERE event_type IN ('signup', 'click', 'purchase') UNION ALL SELECT 'member' FROM documents) GROUP BY topic")
def src5(spark, sf_dir):
    """A new stream reads what was there before it began."""
    folder, out = fresh_dir(spark, "raw-log"), fresh_dir(spark, "copy")
    views.raw_log(spark, sf_dir).select("topic", "value").write.partitionBy("topic").parquet(folder)
    log = read_raw_log(spark, FACT_TOPICS, path=folder)
    (log.writeStream.format("parquet").option("path", out).option("checkpointLocation", fresh_dir(spark, "cp"))
     .trigger(availableNow=True).start().awaitTermination())
    return spark.read.parquet(out).groupBy("topic").agg(F.count("*").alias("n"))


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = views.table(spark, sf_dir, "events").schema
    # A pattern, since a stream takes no path of a single file.
    return views.with_keys(spark.readStream.schema(schema).parquet(f"{sf_dir}/event[s].parquet"))


def _timed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = _event_stream(spark, sf_dir)
    return (member_time(views.member(rows).drop("ts", "event_id")),
            fact_time(views.regtype(rows).drop("ts", "event_id")))


def _landed(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Run an append stream over what is there and read what it wrote."""
    out = fresh_dir(spark, "landed")
    (rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", fresh_dir(spark, "cp"))
     .outputMode("append").trigger(availableNow=True).start().awaitTermination())
    return spark.read.schema(rows.schema).parquet(out)


@check("str2_watermarked", f"SELECT {names('member')}, us FROM member_all")
def str2(spark, sf_dir):
    """A watermark alone drops nothing."""
    landed = _landed(spark, _timed(spark, sf_dir)[0])
    return landed.withColumn("us", F.unix_micros("ts")).drop("ts")


@check("jn1_stream", f"""WITH {jn1_sql(_DAY_US)},
mark AS (SELECT least((SELECT max(us) FROM member_all), (SELECT max(us) FROM regtype_all)) - 10000000 AS w)
SELECT jn1.* FROM jn1, mark WHERE regtype_us IS NOT NULL OR win_us + {_DAY_US} <= w""")
def jn1_stream(spark, sf_dir):
    """Pairs at once; rows without a match once the watermark has passed their window."""
    member, regtype = _timed(spark, sf_dir)
    joined = join_regtype(member, regtype, size=DAY)
    return _landed(spark, joined.withColumn("win_us", F.unix_micros("win.start")).drop("win", "member_tie", "regtype_tie"))


_COGROUPED = "uid string, dn string, register string, appkey string, createtime string"


@check("jn9_cogroup_stream", """
SELECT CAST(m.uid AS VARCHAR) AS uid, m.dn, register, appkey, createtime
FROM member_all m LEFT JOIN regtype_all r
  ON m.uid = r.uid AND m.dn = r.dn AND m.us // 86400000000 = r.us // 86400000000""")
def jn9_stream(spark, sf_dir):
    """A function over both streams, in two runs on one checkpoint; the second one brings a closing day."""
    folder, out, checkpoint = fresh_dir(spark, "events"), fresh_dir(spark, "landed"), fresh_dir(spark, "cp")
    rows = views.events(spark, sf_dir).where("event_type IN ('signup', 'click')")
    shape = rows.schema
    closing = spark.sql(f"SELECT timestamp_micros({_CLOSING_US}) AS ts, -1 AS uid, 'webA' AS dn, k AS event_type, "
                        f"'{_CLOSING_US // 1000}' AS ms FROM VALUES ('signup'), ('click') AS t(k)")

    def left_pairs(l: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        both = l.merge(r, on=["uid", "dn", "win_us"], how="left")
        return both[["uid", "dn", "register", "appkey", "createtime"]].astype(object).where(lambda c: c.notna(), None)

    for part in (rows, rows.limit(0).unionByName(closing, allowMissingColumns=True)):
        part.write.mode("append").parquet(folder)
        stream = spark.readStream.schema(shape).parquet(folder)
        uid, win_us = F.col("uid").cast("string").alias("uid"), F.unix_micros("win.start").alias("win_us")
        left = in_window(member_time(views.member(stream).drop("ts")), "ts", DAY).select(uid, "dn", "win", win_us, "register")
        right = in_window(fact_time(views.regtype(stream).drop("ts")), "ts", DAY).select(uid, "dn", "win", win_us, "appkey", "createtime")
        pairs = cogroup_stream(left, right, ["uid", "dn"], left_pairs, _COGROUPED, rows_per_call=20_000)
        (pairs.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
         .outputMode("append").trigger(availableNow=True).start().awaitTermination())
    return spark.read.schema(_COGROUPED).parquet(out).where("uid <> '-1'")


@check("agg1_running_rows", """
SELECT event_id, event_type, count(*) OVER (PARTITION BY event_type ORDER BY ts, event_id
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS n FROM events""")
def agg1_rows(spark, sf_dir):
    """One updated count for each record, in three runs on one checkpoint; the counts are folded in between."""
    folder, checkpoint = fresh_dir(spark, "events"), fresh_dir(spark, "cp")
    rows = views.table(spark, sf_dir, "events").select("event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    counts = RunningCount(spark, fresh_dir(spark, "running"), [rows.schema["event_type"]])
    cuts = [None, "2024-01-10", "2024-01-20", None]
    for begin, end in zip(cuts, cuts[1:]):
        part = rows.where(" AND ".join([f"ts >= '{begin}'"] * bool(begin) + [f"ts < '{end}'"] * bool(end)))
        part.write.mode("append").parquet(folder)
        stream = spark.readStream.schema(rows.schema).parquet(folder)
        start_running_count(stream, counts, checkpoint, "ts", ["event_id"], compact_after=2).awaitTermination()
    return counts.read(rows.schema).drop("ts")


@check("str8_early_results", f"WITH {jn1_sql(_DAY_US)} SELECT * FROM jn1")
def str8(spark, sf_dir):
    """Early results in two runs on one checkpoint, registrations after members. No window stays open."""
    folder, checkpoint = fresh_dir(spark, "events"), fresh_dir(spark, "cp")
    rows = views.events(spark, sf_dir)
    table = None
    for kind in ("event_type <> 'click'", "event_type = 'click'"):
        rows.where(kind).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(rows.schema).parquet(folder)
        member, regtype = (view(stream).drop("ts") for view in (views.member, views.regtype))
        # The registrations are behind in time, but belong to windows that the members have to wait in.
        changes = early_changes(member_time(member, lateness="40 days"), fact_time(regtype, lateness="40 days"),
                                size=DAY, record="event_id")
        table = table or early_table(spark, fresh_dir(spark, "early"), changes.schema)
        start_early_table(changes, table, checkpoint).awaitTermination()
    return standing(table)


_TOPIC_SESSIONS = """
WITH log AS (
  SELECT CASE event_type WHEN 'signup' THEN 'member' WHEN 'click' THEN 'memberregtype' WHEN 'purchase' THEN 'memberpaymoney'
         WHEN 'view' THEN 'basewebsite' ELSE 'basead' END AS topic, us FROM ev
  UNION ALL SELECT 'membervip', epoch_us(o_orderdate) FROM orders UNION ALL SELECT 'member', 0 FROM documents),
-- One row for each time, since records of one time have no order.
t AS (SELECT topic, us, count(*) AS rows FROM log GROUP BY topic, us),
g AS (SELECT *, CASE WHEN us - lag(us) OVER (PARTITION BY topic ORDER BY us) <= 300000000 THEN 0 ELSE 1 END AS opens FROM t),
s AS (SELECT *, sum(opens) OVER (PARTITION BY topic ORDER BY us ROWS UNBOUNDED PRECEDING) AS number FROM g)
SELECT topic, min(us) AS start_us, max(us) + 300000000 AS end_us, CAST(sum(rows) AS BIGINT) AS n FROM s GROUP BY topic, number"""


@check("str7_arrival_sessions", _TOPIC_SESSIONS)
def str7_arrival(spark, sf_dir):
    """Sessions of the topics by arrival, in two runs on one checkpoint; the second one brings a closing day."""
    folder, out, checkpoint = fresh_dir(spark, "raw"), fresh_dir(spark, "landed"), fresh_dir(spark, "cp")
    topics = [*FACT_TOPICS, *DIMENSION_TOPICS]
    for part in (views.raw_log(spark, sf_dir), _closing_log(spark)):
        part.write.mode("append").partitionBy("topic").parquet(folder)
        log = read_raw_log(spark, topics, path=folder, arrival=True)
        found = flat_window(arrival_sessions(log, ["topic"], "5 minutes"))
        (found.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
         .outputMode("append").trigger(availableNow=True).start().awaitTermination())
    return spark.read.schema(found.schema).parquet(out)


@check("str7_session_window", session_sql(3_600_000_000, "user_id"))
def str7_window(spark, sf_dir):
    """Sessions of the users, as a stream."""
    folder, out, checkpoint = fresh_dir(spark, "events"), fresh_dir(spark, "landed"), fresh_dir(spark, "cp")
    rows = views.events(spark, sf_dir).select("user_id", F.col("us").alias("arrived"))
    closing = spark.sql(f"SELECT -1L AS user_id, {_CLOSING_US}L AS arrived")
    for part in (rows, closing.to(rows.schema)):
        part.write.mode("append").parquet(folder)
        stream = spark.readStream.schema(rows.schema).parquet(folder)
        found = flat_window(arrival_sessions(stream, ["user_id"], "1 hour"))
        (found.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
         .outputMode("append").trigger(availableNow=True).start().awaitTermination())
    return spark.read.schema(found.schema).parquet(out)


def _late_half(spark: SparkSession, sf_dir: str, lateness: str) -> DataFrame:
    """Counts per day when the first half of the events arrives after the second one."""
    folder, checkpoint = fresh_dir(spark, "events"), fresh_dir(spark, "cp")
    rows = views.events(spark, sf_dir).select("ms", "us", "event_type", "ts")
    counts = UpsertTable(
        spark, fresh_dir(spark, "counts"),
        spark.range(0).selectExpr("id AS win_us", "CAST(id AS string) AS event_type", "id AS n").schema,
        ["win_us", "event_type"])
    stream = None
    for part in (rows.where(f"ts >= {_CUT}"), rows.where(f"ts < {_CUT}")):
        part.select("ms", "event_type").write.mode("append").parquet(folder)
        stream = spark.readStream.schema("ms string, event_type string").parquet(folder)
        timed = member_time(stream.withColumnRenamed("ms", "register"), lateness=lateness)
        counted = tumbling_counts(timed, ["event_type"], "ts", DAY)
        flat = counted.select(F.unix_micros("win.start").alias("win_us"), "event_type", "n")
        (flat.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
         .foreachBatch(lambda batch, number: counts.upsert(batch, number, ["n"]))
         .trigger(availableNow=True).start().awaitTermination())
    return counts.read()


@check("str10_late_rows_dropped", f"""
SELECT us // {_DAY_US} * {_DAY_US} AS win_us, event_type, count(*) AS n FROM ev WHERE us >= {_CUT_US} GROUP BY ALL""")
def str10(spark, sf_dir):
    return _late_half(spark, sf_dir, "0 seconds")


@check("str9_allowed_lateness", f"""
SELECT us // {_DAY_US} * {_DAY_US} AS win_us, event_type, count(*) AS n FROM ev GROUP BY ALL""")
def str9(spark, sf_dir):
    return _late_half(spark, sf_dir, "40 days")


@check("str11_login_state", """
WITH g AS (SELECT user_id, us, lag(us) OVER (PARTITION BY user_id ORDER BY us) AS before_us FROM ev)
SELECT user_id, us, CASE WHEN us - before_us <= 3600000000 THEN before_us END AS previous_us FROM g""")
def str11_state(spark, sf_dir):
    """Four runs on one checkpoint, each with the logins of one stretch of time."""
    folder, out, checkpoint = fresh_dir(spark, "logins"), fresh_dir(spark, "landed"), fresh_dir(spark, "cp")
    rows = views.table(spark, sf_dir, "events").select("user_id", "ts")
    cuts = [None, "2024-01-08", "2024-01-15", "2024-01-22", None]
    for begin, end in zip(cuts, cuts[1:]):
        part = rows.where(" AND ".join([f"ts >= '{begin}'"] * bool(begin) + [f"ts < '{end}'"] * bool(end)))
        part.selectExpr("user_id", "CAST(ts AS timestamp) AS ts").write.mode("append").parquet(folder)
        logins = last_logins(spark.readStream.schema("user_id long, ts timestamp").parquet(folder), ["user_id"])
        (logins.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
         .outputMode("append").trigger(availableNow=True).start().awaitTermination())
    return spark.read.schema("user_id long, us long, previous_us long").parquet(out)


@check("udf2_two_outputs", """
SELECT event_type, CASE WHEN event_type IN ('view', 'error') THEN 'dimension' ELSE 'fact' END AS output, count(*) AS n
FROM ev GROUP BY ALL""")
def udf2(spark, sf_dir):
    out = fresh_dir(spark, "outputs")
    dimension = F.col("event_type").isin("view", "error")
    rows = _event_stream(spark, sf_dir).select("event_id", "event_type")
    (rows.writeStream.foreachBatch(jobs.fan_out({"fact": ~dimension, "dimension": dimension}, out))
     .option("checkpointLocation", fresh_dir(spark, "cp")).trigger(availableNow=True).start().awaitTermination())
    return spark.read.parquet(out).groupBy("event_type", "output").agg(F.count("*").alias("n"))


_CLOSING_US = 4_102_444_800_000_000  # a far day that lets every window of the data close


def _closing_log(spark: SparkSession) -> DataFrame:
    ms = str(_CLOSING_US // 1000)
    return spark.sql(f"""
      SELECT topic, to_json(named_struct('uid', '-1', 'dn', 'webA', 'register', '{ms}', 'createtime', '{ms}')) AS value,
             {_CLOSING_US}L AS arrived, 0L AS offset
      FROM VALUES ('member'), ('memberregtype'), ('memberpaymoney') AS t(topic)""")


@check("str3_raw_log_to_wide_table", f"""WITH {jn1_sql(_DAY_US)}, {JN2},
ads2 AS ({_latest_sql('ad_log', 'adid', names('ads'))}),
websites2 AS ({_latest_sql('website_log', 'siteid', names('websites'))}),
vips2 AS ({_latest_sql('vip_log', 'vip_id', names('vips'))}),
""" + JN6.replace("FROM ads)", "FROM ads2)").replace("FROM websites)", "FROM websites2)").replace("FROM vips)", "FROM vips2)").strip()
       + f""",
merged AS ({last_values_sql('jn6', PAIR_ORDER, MERGED)})
SELECT substr(md5(CAST(uid AS VARCHAR)), 1, 5) || uid || dn AS row_key, {STORED} FROM merged""")
def str3(spark, sf_dir):
    """All streaming jobs one after the other: raw log, second layer and dimension tables, wide table without pairs.

    A day holds several ids of a member, of which the dimensions know some. The joins are stopped and go on from their checkpoint when the closing rows have come.
    """
    raw, second, tables_at = fresh_dir(spark, "raw"), fresh_dir(spark, "second"), fresh_dir(spark, "tables")
    fact_cp, dim_cp, join_cp = (fresh_dir(spark, "cp") for _ in range(3))
    tables = ods.dimension_tables(spark, tables_at)
    wide = wide_table(spark, fresh_dir(spark, "wide"))
    for part in (views.raw_log(spark, sf_dir), _closing_log(spark)):
        part.write.mode("append").partitionBy("topic").parquet(raw)
        jobs.start_fact_stream(read_raw_log(spark, FACT_TOPICS, path=raw), fact_cp, path=second).awaitTermination()
        dims = read_raw_log(spark, DIMENSION_TOPICS, path=raw, arrival=True)
        jobs.start_dimension_stream(dims, tables, dim_cp).awaitTermination()
        facts = read_raw_log(spark, [f"dwd{t}" for t in FACT_TOPICS], path=second)
        jobs.start_collapsed_member_stream(
            member_time(member_records(facts)), fact_time(regtype_records(facts)), fact_time(payment_records(facts)),
            tables, wide, join_cp, dead_letter_path=fresh_dir(spark, "dead"), size=DAY,
        ).awaitTermination()
    return wide.read().where("uid <> -1")
