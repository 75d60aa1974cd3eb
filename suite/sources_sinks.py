"""Checks of sources and sinks. The sinks write to the shared folder and what they wrote is read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rollcall.operators import dimension_rows
from rollcall.operators.joins import join_member_facts
from rollcall.operators.words import count_words, labelled_counts, words_on_whitespace
from rollcall.plans import ods
from rollcall.plans.member_wide import enrich, upsert_members, wide_rows, wide_table
from rollcall.schemas import (
    AD_TABLE, FACT_TOPICS, VIP_TABLE, WEBSITE_TABLE, Dimension,
)
from rollcall.session import fresh_dir
from rollcall.sinks.client_sink import client_sink
from rollcall.sinks.topic_log import append_facts, write_text_topic
from rollcall.sinks.upsert_table import UpsertTable
from rollcall.sources import (
    ad_dimension, member_records, payment_records, read_lines, read_raw_log, regtype_records,
    vip_dimension, website_dimension,
)
from rollcall.streaming.event_time import with_event_time

from . import views
from .folder_client import folder_client, read_folder
from .joins import JN2, JN6, MERGED, PAIR_ORDER, STORED, WIDE, jn1_sql, last_values_sql
from .registry import check
from .views import DAY, names

_DAY_US = 86_400_000_000


@check("src1_raw_log", """
SELECT 'basewebsite' AS topic, arrived, "offset", CAST(siteid AS VARCHAR) AS id, sitename AS name, creator, dn FROM website_log
UNION ALL SELECT 'basead', arrived, "offset", CAST(adid AS VARCHAR), adname, NULL, dn FROM ad_log""")
def src1(spark, sf_dir):
    """Two of six topics; the topic filter prunes directories."""
    path = fresh_dir(spark, "raw-log")
    views.raw_log(spark, sf_dir).write.partitionBy("topic").parquet(path)
    log = read_raw_log(spark, ["basead", "basewebsite"], path=path, stream=False, arrival=True)
    field = lambda *names: F.coalesce(*[F.get_json_object("value", f"$.{n}") for n in names])
    return log.select(
        "topic", "arrived", "offset", field("siteid", "adid").alias("id"), field("sitename", "adname").alias("name"),
        field("creator").alias("creator"), field("dn").alias("dn"))


def _second_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ods.fact_log(views.stored_log(spark, sf_dir))


@check("src2_member_records", f"SELECT {names('member')} FROM member_all")
def src2(spark, sf_dir):
    return member_records(_second_layer(spark, sf_dir))


@check("src3_payment_records", f"SELECT {names('payment')} FROM payment_all")
def src3(spark, sf_dir):
    return payment_records(_second_layer(spark, sf_dir))


@check("src4_regtype_records", f"SELECT {names('regtype')} FROM regtype_all")
def src4(spark, sf_dir):
    return regtype_records(_second_layer(spark, sf_dir))


@check("src6_text_lines", """
WITH l AS (SELECT unnest(string_split(replace(text, chr(13), chr(10)), chr(10))) AS line FROM documents)
SELECT line, count(*) AS n FROM l GROUP BY line""")
def src6(spark, sf_dir):
    path = fresh_dir(spark, "lines")
    views.lines(spark, sf_dir).select("line").write.text(path)
    return read_lines(spark, path, stream=False).groupBy("line").agg(F.count("*").alias("n"))


@check("src7_ad_names", "SELECT adid AS ad_id, dn, adname FROM ads")
def src7(spark, sf_dir):
    return ad_dimension(views.ads(spark, sf_dir))


@check("src8_websites", """
SELECT siteid, dn, sitename, siteurl, "delete", createtime AS site_createtime, creator AS site_creator FROM websites""")
def src8(spark, sf_dir):
    return website_dimension(views.websites(spark, sf_dir))


@check("src9_vips", """
SELECT vip_id, dn, vip_level, start_time AS vip_start_time, end_time AS vip_end_time, last_modify_time,
       max_free, min_free, next_level, operator FROM vips""")
def src9(spark, sf_dir):
    return vip_dimension(views.vips(spark, sf_dir))


def _half(arrived: str = "arrived"):
    """Cut at a fixed time inside the data; the two batches together are the whole log."""
    return F.col(arrived) < F.lit(1_705_276_800_000_000)


def _two_batches(spark: SparkSession, sf_dir: str, dimension: Dimension, table: UpsertTable) -> UpsertTable:
    """All versions in two batches, the second one written twice."""
    versions = ods.dimension_versions(views.stored_log(spark, sf_dir), dimension)
    order = ods.ARRIVAL_ORDER
    table.upsert(versions.where(_half()), 0, order)
    for _ in range(2):
        table.upsert(versions.where(~_half()), 1, order)
    return table


def _upserted(spark: SparkSession, sf_dir: str, dimension: Dimension) -> DataFrame:
    table = ods.dimension_table(spark, fresh_dir(spark, "tables"), dimension)
    return _two_batches(spark, sf_dir, dimension, table).read()


def _latest_sql(log: str, key: str, columns: str) -> str:
    return (f'SELECT {columns} FROM {log} '
            f'QUALIFY row_number() OVER (PARTITION BY {key}, dn ORDER BY arrived DESC, "offset" DESC) = 1')


@check("snk1_upsert_websites", _latest_sql("website_log", "siteid", names("websites")))
def snk1(spark, sf_dir):
    return _upserted(spark, sf_dir, WEBSITE_TABLE)


@check("snk2_upsert_ads", _latest_sql("ad_log", "adid", names("ads")))
def snk2(spark, sf_dir):
    return _upserted(spark, sf_dir, AD_TABLE)


@check("snk3_upsert_vips", _latest_sql("vip_log", "vip_id", names("vips")))
def snk3(spark, sf_dir):
    return _upserted(spark, sf_dir, VIP_TABLE)


@check("snk3_compacted", _latest_sql("vip_log", "vip_id", names("vips")))
def snk3_compacted(spark, sf_dir):
    """The same after folding the batches into one base."""
    table = ods.dimension_table(spark, fresh_dir(spark, "tables"), VIP_TABLE)
    _two_batches(spark, sf_dir, VIP_TABLE, table).compact()
    return table.read()


def _typed(spark: SparkSession, sf_dir: str, dimension: Dimension, project, keys) -> DataFrame:
    """Typed rows in a table of their own layout."""
    versions = ods.dimension_versions(views.stored_log(spark, sf_dir), dimension)
    order = ods.ARRIVAL_ORDER
    rows = project(versions, order)
    table = UpsertTable(spark, fresh_dir(spark, "typed"), rows.drop(*order).schema, keys)
    table.upsert(rows, 0, order)
    return table.read()


@check("snk4_typed_websites", "SELECT siteid AS site_id, sitename, siteurl, TRY_CAST(\"delete\" AS INTEGER) AS \"delete\", "
       "createtime, creator, dn FROM (" + _latest_sql("website_log", "siteid", "*") + ")")
def snk4(spark, sf_dir):
    return _typed(spark, sf_dir, WEBSITE_TABLE, dimension_rows.typed_website, ("site_id", "dn"))


@check("snk5_typed_ads", _latest_sql("ad_log", "adid", names("ads")))
def snk5(spark, sf_dir):
    return _typed(spark, sf_dir, AD_TABLE, dimension_rows.typed_ad, ("adid", "dn"))


@check("snk6_typed_vips", """SELECT vip_id, vip_level, epoch_us(TRY_CAST(start_time AS TIMESTAMP)) AS start_us,
  epoch_us(TRY_CAST(end_time AS TIMESTAMP)) AS end_us,
  CASE WHEN length(last_modify_time) > 10 THEN epoch_us(TRY_CAST(last_modify_time AS TIMESTAMP)) END AS modified_us,
  max_free, min_free, next_level, operator, dn FROM (""" + _latest_sql("vip_log", "vip_id", "*") + ")")
def snk6(spark, sf_dir):
    rows = _typed(spark, sf_dir, VIP_TABLE, dimension_rows.typed_vip, ("vip_id", "dn"))
    return rows.select(
        "vip_id", "vip_level", F.unix_micros("start_time").alias("start_us"), F.unix_micros("end_time").alias("end_us"),
        F.unix_micros("last_modify_time").alias("modified_us"), "max_free", "min_free", "next_level", "operator", "dn")


@check("snk7_upsert_members", f"""WITH {jn1_sql(_DAY_US)}, {JN2}, {JN6},
merged AS ({last_values_sql('jn6', PAIR_ORDER, MERGED)})
SELECT substr(md5(CAST(uid AS VARCHAR)), 1, 5) || uid || dn AS row_key, {STORED} FROM merged""")
def snk7(spark, sf_dir):
    """Pairs upserted in two batches; the cut lies between two windows."""
    pairs = enrich(join_member_facts(*views.facts(spark, sf_dir), size=DAY), *views.dimensions(spark, sf_dir))
    table = wide_table(spark, fresh_dir(spark, "wide"))
    upsert_members(pairs.where(_half("member_us")), 0, table)
    upsert_members(pairs.where(~_half("member_us")), 1, table)
    return table.read()


@check("snk9_second_layer", """
SELECT 'dwdmember' AS topic, CAST(uid AS VARCHAR) AS uid, register AS at FROM member_all
UNION ALL SELECT 'dwdmemberregtype', CAST(uid AS VARCHAR), createtime FROM regtype_all
UNION ALL SELECT 'dwdmemberpaymoney', CAST(uid AS VARCHAR), createtime FROM payment_all""")
def snk9(spark, sf_dir):
    path = fresh_dir(spark, "second-layer")
    append_facts(views.stored_log(spark, sf_dir), path)
    topics = [f"dwd{t}" for t in FACT_TOPICS]
    log = read_raw_log(spark, topics, path=path, stream=False)
    return log.select(
        "topic", F.get_json_object("value", "$.uid").alias("uid"),
        F.coalesce(F.get_json_object("value", "$.register"), F.get_json_object("value", "$.createtime")).alias("at"))


@check("snk10_text_topic", r"""
WITH w AS (SELECT unnest(string_split_regex(text, '\s')) AS word FROM documents)
SELECT word || '::' || count(*) AS value FROM w GROUP BY word""")
def snk10(spark, sf_dir):
    path = fresh_dir(spark, "text-topic")
    counted = labelled_counts(count_words(words_on_whitespace(views.lines(spark, sf_dir))))
    write_text_topic(counted, "counts", 0, path=path)
    return spark.read.parquet(path).select("value")


@check("ods_dimension_rows", _latest_sql("website_log", "siteid", names("websites")))
def ods_rows(spark, sf_dir):
    """The table straight from the whole log, with no upserts between."""
    return ods.dimension_rows(views.stored_log(spark, sf_dir), WEBSITE_TABLE)


@check("ods_to_wide_rows", f"""WITH {jn1_sql(_DAY_US)}, {JN2},
ads2 AS ({_latest_sql('ad_log', 'adid', names('ads'))}),
websites2 AS ({_latest_sql('website_log', 'siteid', names('websites'))}),
vips2 AS ({_latest_sql('vip_log', 'vip_id', names('vips'))}),
""" + JN6.replace("FROM ads)", "FROM ads2)").replace("FROM websites)", "FROM websites2)").replace("FROM vips)", "FROM vips2)").strip()
       + f" SELECT {WIDE}, ad_hit, site_hit, vip_hit FROM jn6")
def ods_to_wide(spark, sf_dir):
    """All layers with stored tables between: filter, routing, decoding, dimension upserts, joins, lookups."""
    log = views.stored_log(spark, sf_dir)
    second = fresh_dir(spark, "second-layer")
    append_facts(log, second)
    tables = ods.dimension_tables(spark, fresh_dir(spark, "tables"))
    ods.upsert_dimensions(log, 0, tables)
    facts = read_raw_log(spark, [f"dwd{t}" for t in FACT_TOPICS], path=second, stream=False)
    member = with_event_time(member_records(facts), "register")
    regtype = with_event_time(regtype_records(facts), "createtime")
    payment = with_event_time(payment_records(facts), "createtime")
    dimensions = [tables[d.table].read() for d in (AD_TABLE, WEBSITE_TABLE, VIP_TABLE)]
    rows = wide_rows(member, regtype, payment, *dimensions, size=DAY)
    return rows.withColumns({c: F.col(c).cast("int") for c in ("ad_hit", "site_hit", "vip_hit")})


@check("udf4_client_sink", "SELECT event_id, user_id, event_type, value FROM events")
def udf4(spark, sf_dir):
    """Three batches through a client, one of them written twice and counted once."""
    root = fresh_dir(spark, "client")
    spark.dataSource.register(client_sink("folder_client", folder_client(), rows=5_000))
    rows = views.table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", F.col("ts").cast("timestamp").alias("ts"))
    cuts = [None, "2024-01-10", "2024-01-20", None]
    for batch in (0, 1, 1, 2):
        begin, end = cuts[batch: batch + 2]
        part = rows.where(" AND ".join([f"ts >= '{begin}'"] * bool(begin) + [f"ts < '{end}'"] * bool(end))).drop("ts")
        part.write.format("folder_client").option("root", root).option("batch", str(batch)).mode("append").save()
    return read_folder(spark, root, rows.drop("ts").schema)
