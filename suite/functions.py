"""Checks of the scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollcall import functions as fn

from . import views
from .registry import check


@check("fn1_md5", "SELECT event_id, md5(CAST(uid AS VARCHAR)) AS hash FROM ev")
def fn1(spark, sf_dir):
    return views.events(spark, sf_dir).select("event_id", fn.md5_hex(F.col("uid")).alias("hash"))


@check("fn2_row_key", "SELECT event_id, substr(md5(CAST(uid AS VARCHAR)), 1, 5) || uid || dn AS row_key FROM ev")
def fn2(spark, sf_dir):
    return views.events(spark, sf_dir).select(
        "event_id", fn.salted_row_key(F.col("uid"), F.col("dn")).alias("row_key"))


@check("fn3_safe_json_parse", """
WITH v AS (SELECT event_id AS id, props AS value FROM ev UNION ALL SELECT doc_id, text FROM documents)
SELECT id, CASE WHEN (CASE WHEN json_valid(value) THEN json_type(value) = 'OBJECT' ELSE FALSE END)
                THEN json_extract_string(value, '$.k') END AS k,
       CAST((CASE WHEN json_valid(value) THEN json_type(value) = 'OBJECT' ELSE FALSE END) AS INTEGER) AS is_object
FROM v""")
def fn3(spark, sf_dir):
    values = views.table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.col("props").alias("value"))
    texts = views.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("value"))
    parsed = fn.json_object(F.col("value"))
    return values.unionByName(texts).select(
        "id", parsed["k"].alias("k"), parsed.isNotNull().cast("int").alias("is_object"))


@check("fn4_json_field", "SELECT event_id, k FROM ev")
def fn4(spark, sf_dir):
    return views.table(spark, sf_dir, "events").select("event_id", fn.json_field(F.col("props"), "k").alias("k"))


@check("fn5_json_text", """
SELECT event_id, '{"uid":' || uid || ',"register":"' || register || '"' ||
       coalesce(',"lastlogin":"' || lastlogin || '"', '') || '}' AS value FROM member_all""")
def fn5(spark, sf_dir):
    member = views.member(views.events(spark, sf_dir))
    return member.select("event_id", fn.json_text("uid", "register", "lastlogin").alias("value"))


@check("fn6_utf8", "SELECT doc_id, text, octet_length(encode(text)) AS n_bytes FROM documents")
def fn6(spark, sf_dir):
    encoded = fn.to_bytes(F.col("text"))
    return views.table(spark, sf_dir, "documents").select(
        "doc_id", fn.to_text(encoded).alias("text"), F.octet_length(encoded).cast("bigint").alias("n_bytes"))


@check("fn7_text_to_number", """
SELECT event_id, CAST(ms AS BIGINT) AS millis,
       CASE WHEN event_type = 'view' THEN NULL ELSE CAST(k AS INTEGER) END AS k FROM ev""")
def fn7(spark, sf_dir):
    rows = views.events(spark, sf_dir)
    text = F.when(F.col("event_type") == "view", F.concat("k", F.lit("x"))).otherwise(F.col("k"))
    return rows.select(
        "event_id", F.unix_millis("ts").cast("string").try_cast("bigint").alias("millis"),
        text.try_cast("int").alias("k"))


@check("fn8_text_to_timestamp", """
SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN epoch_us(o_orderdate) + 45000000000 END AS us FROM orders""")
def fn8(spark, sf_dir):
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    text = F.when(F.col("o_orderkey") % 2 == 0, F.concat(day, F.lit(" 12:30:00"))).otherwise(day)
    return views.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.unix_micros(fn.parse_datetime(text)).alias("us"))


@check("fn9_target_topic", "SELECT event_id, 'dwd' || event_type AS topic FROM ev")
def fn9(spark, sf_dir):
    return views.table(spark, sf_dir, "events").select("event_id", fn.target_topic(F.col("event_type")).alias("topic"))


@check("fn10_ipv4", """
WITH n AS (SELECT event_id, event_id * 2654435761 % 4294967296 AS x FROM ev)
SELECT event_id, concat_ws('.', (x >> 24) & 255, (x >> 16) & 255, (x >> 8) & 255, x & 255) AS ip FROM n""")
def fn10(spark, sf_dir):
    """Half of the numbers are negative as 32-bit ones."""
    unsigned = F.col("event_id") * 2654435761 % 4294967296
    signed = F.when(unsigned >= 2**31, unsigned - 2**32).otherwise(unsigned)
    return views.table(spark, sf_dir, "events").select("event_id", fn.ipv4(signed).alias("ip"))


@check("fn11_partition_date", "SELECT event_id, dt FROM ev")
def fn11(spark, sf_dir):
    return views.table(spark, sf_dir, "events").select("event_id", fn.partition_date(F.col("ts")).alias("dt"))


@check("fn12_money_text", """
SELECT l_orderkey, l_linenumber, printf('%.2f', l_extendedprice * l_discount) AS amount FROM lineitem""")
def fn12(spark, sf_dir):
    return views.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", fn.money_text(F.col("l_extendedprice") * F.col("l_discount")).alias("amount"))
