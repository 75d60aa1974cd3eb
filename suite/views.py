"""Member streams, dimension tables and a raw log, seen in the given tables.

``SQL`` holds the same views for the SQL side; every check starts with it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rollcall.operators.latest import latest_rows
from rollcall.schemas import AD, DIMENSION_TOPICS, FACT_TOPICS, MEMBER, PAYMENT, REGTYPE, VIP, WEBSITE
from rollcall.session import fresh_dir
from rollcall.sources.raw_log import read_raw_log

DAY = "1 day"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_keys(events: DataFrame) -> DataFrame:
    """Events with member key, time in microseconds and the number in their props."""
    return events.selectExpr(
        "event_id", "CAST(ts AS timestamp) AS ts", "user_id", "event_type", "value", "props",
        "CAST(user_id AS int) AS uid",
        "concat('web', substr('ABC', CAST(user_id % 3 + 1 AS int), 1)) AS dn",
        "get_json_object(props, '$.k') AS k", "unix_micros(CAST(ts AS timestamp)) AS us",
        "CAST(unix_millis(CAST(ts AS timestamp)) AS string) AS ms",
        "date_format(date_sub(to_date(ts), 8), 'yyyyMMdd') AS dt",
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_keys(table(spark, sf_dir, "events"))


def _octet(bits: int) -> str:
    return f"shiftright(CAST(event_id * 2654435 % 2147483647 AS int), {bits}) & 255"


# Each record kind as field -> expression over ``events``.
MEMBER_FIELDS = {
    "uid": "uid", "ad_id": "CAST(event_id % 30 AS int)",
    "birthday": "date_format(date_add(DATE '1960-01-01', CAST(user_id % 14000 AS int)), 'yyyy-MM-dd')",
    "email": "concat('u', user_id, '@mail.test')", "fullname": "concat('user', user_id)", "iconurl": "'-'",
    "lastlogin": "IF(event_id % 4 <> 0, concat('l', event_id), NULL)", "mailaddr": "'-'",
    "memberlevel": "CAST(user_id % 8 + 1 AS string)", "password": "'pw-field'", "paymoney": "'-'",
    "phone": "concat('0170', user_id)", "qq": "'44001'", "register": "ms", "regupdatetime": "'-'", "unitname": "'-'",
    "userip": f"concat_ws('.', {_octet(24)}, {_octet(16)}, {_octet(8)}, {_octet(0)})", "zipcode": "'-'",
    "dt": "dt", "dn": "dn",
}
REGTYPE_FIELDS = {
    "uid": "uid", "appkey": "concat('k', k)", "appregurl": "concat('http://reg', event_id % 4, '.test/')",
    "bdp_uuid": "IF(event_id % 3 <> 0, concat('b', event_id), NULL)", "createtime": "ms", "isranreg": "'-'",
    "regsource": "CAST(event_id % 5 AS string)", "websiteid": "CAST(event_id % 4 AS string)", "dt": "dt", "dn": "dn",
}
PAYMENT_FIELDS = {
    "uid": "uid", "paymoney": "format_number(value, '0.00')", "siteid": "CAST(event_id % 7 AS int)",
    "vip_id": "CAST(event_id % 6 AS int)", "createtime": "ms", "dt": "dt", "dn": "dn",
}
WEBSITE_FIELDS = {
    "siteid": "CAST(event_id % 5 AS int)", "sitename": "concat('site', k)", "siteurl": "concat('http://s', k, '.test/')",
    "delete": "IF(event_id % 5 = 0, 'no', CAST(event_id % 2 AS string))", "createtime": "'2000-01-01'",
    "creator": "concat('c', user_id)", "dn": "dn",
}
AD_FIELDS = {"adid": "CAST(event_id % 30 AS int)", "adname": "concat('ad', k)", "dn": "dn"}
_ORDER_DAY = "date_format(o_orderdate, 'yyyy-MM-dd')"
VIP_FIELDS = {
    "vip_id": "CAST(o_orderkey % 6 AS int)", "vip_level": "o_orderpriority",
    "start_time": f"concat({_ORDER_DAY}, ' 00:00:00')", "end_time": f"concat({_ORDER_DAY}, ' 23:59:59')",
    "last_modify_time": f"IF(o_orderkey % 2 = 0, concat({_ORDER_DAY}, ' 12:30:00'), {_ORDER_DAY})",
    "max_free": "CAST(o_orderkey AS string)", "min_free": "'0'", "next_level": "o_orderstatus", "operator": "'op'",
    "dn": "concat('web', substr('ABC', CAST(o_custkey % 3 + 1 AS int), 1))",
}


def _wire(fields: dict[str, str]) -> str:
    """As producers send it: every field a string."""
    return "to_json(named_struct(" + ", ".join(f"'{n}', CAST({e} AS string)" for n, e in fields.items()) + "))"


def _of_type(rows: DataFrame, event_type: str, fields: dict[str, str]) -> DataFrame:
    """Typed records plus event time and event id."""
    return rows.where(F.col("event_type") == event_type).selectExpr(
        *[f"{e} AS `{n}`" for n, e in fields.items()], "timestamp_millis(CAST(ms AS bigint)) AS ts", "event_id")


def member(rows: DataFrame) -> DataFrame:
    return _of_type(rows, "signup", MEMBER_FIELDS)


def regtype(rows: DataFrame) -> DataFrame:
    return _of_type(rows, "click", REGTYPE_FIELDS)


def payment(rows: DataFrame) -> DataFrame:
    return _of_type(rows, "purchase", PAYMENT_FIELDS)


# A time before all events, from which they can be squeezed together.
BEGIN_US = 1_704_067_200_000_000


def facts(spark: SparkSession, sf_dir: str, squeeze: int = 1) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Member, registration and payment rows; ``squeeze`` divides the time since the beginning, for small windows."""
    rows = events(spark, sf_dir)
    ts = F.expr(f"timestamp_micros({BEGIN_US} + (unix_micros(ts) - {BEGIN_US}) div {squeeze})")
    return tuple(view(rows).drop("event_id").withColumn("ts", ts) for view in (member, regtype, payment))


def ads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").selectExpr("n_nationkey AS adid", "n_name AS adname", "'webA' AS dn")


def websites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each supplier is a version of one of fifteen sites; the last one counts."""
    versions = table(spark, sf_dir, "supplier").selectExpr(
        "CAST(s_suppkey % 5 AS int) AS siteid", "s_name AS sitename", "concat('http://', s_suppkey, '.test/') AS siteurl",
        "'0' AS `delete`", "'2000-01-01' AS createtime", "'admin' AS creator",
        "concat('web', substr('ABC', CAST(s_suppkey div 5 % 3 + 1 AS int), 1)) AS dn", "s_suppkey AS version",
    )
    return latest_rows(versions, ("siteid", "dn"), ("version",)).drop("version")


def vips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "region").selectExpr(
        "r_regionkey AS vip_id", "r_name AS vip_level", "'2019-01-01 00:00:00' AS start_time",
        "'2020-01-01 00:00:00' AS end_time", "'2019-06-01 12:00:00' AS last_modify_time",
        "concat('max', r_regionkey) AS max_free", "concat('min', r_regionkey) AS min_free", "'next' AS next_level",
        "'op' AS operator", "'webA' AS dn",
    )


def dimensions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return ads(spark, sf_dir), websites(spark, sf_dir), vips(spark, sf_dir)


def raw_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """topic, value, arrived, offset: events and orders as JSON records, documents as junk between them."""
    # Which topic an event type stands for.
    kinds = {
        "signup": ("member", MEMBER_FIELDS), "click": ("memberregtype", REGTYPE_FIELDS),
        "purchase": ("memberpaymoney", PAYMENT_FIELDS), "view": ("basewebsite", WEBSITE_FIELDS),
        "error": ("basead", AD_FIELDS),
    }
    topic = " ".join(f"WHEN '{kind}' THEN '{name}'" for kind, (name, _) in kinds.items())
    value = " ".join(f"WHEN '{kind}' THEN {_wire(fields)}" for kind, (_, fields) in kinds.items())
    from_events = events(spark, sf_dir).selectExpr(
        f"CASE event_type {topic} END AS topic", f"CASE event_type {value} END AS value",
        "us AS arrived", "event_id AS offset")
    from_orders = table(spark, sf_dir, "orders").selectExpr(
        "'membervip' AS topic", f"{_wire(VIP_FIELDS)} AS value",
        "unix_micros(CAST(o_orderdate AS timestamp)) AS arrived", "o_orderkey AS offset")
    junk = table(spark, sf_dir, "documents").selectExpr(
        "'member' AS topic", "text AS value", "0L AS arrived", "doc_id AS offset")
    return from_events.unionByName(from_orders).unionByName(junk)


_logs: dict[tuple[str, str], str] = {}


def stored_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw log written out by topic, once for an application, and read again, as a job finds it."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _logs:
        path = fresh_dir(spark, "raw-log")
        raw_log(spark, sf_dir).write.partitionBy("topic").parquet(path)
        _logs[key] = path
    path = _logs[key]
    return read_raw_log(spark, [*FACT_TOPICS, *DIMENSION_TOPICS], path=path, stream=False, arrival=True)


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("line"))


LAYOUTS = {"member": MEMBER, "regtype": REGTYPE, "payment": PAYMENT, "ads": AD, "websites": WEBSITE, "vips": VIP}


def names(kind: str, *without: str, prefix: str = "") -> str:
    """Column list of a record kind for the SQL side."""
    return ", ".join(f'{prefix}"{n}"' for n in LAYOUTS[kind].fieldNames() if n not in without)


SQL = """
WITH ev AS (
  SELECT event_id, ts, user_id, event_type, value, props, CAST(user_id AS INTEGER) AS uid,
         'web' || substr('ABC', CAST(user_id % 3 + 1 AS INTEGER), 1) AS dn,
         json_extract_string(props, '$.k') AS k, epoch_us(ts) AS us,
         CAST(epoch_us(ts) // 1000 AS VARCHAR) AS ms,
         strftime(CAST(ts AS DATE) - 8, '%Y%m%d') AS dt
  FROM events),
member_all AS (
  SELECT uid, CAST(event_id % 30 AS INTEGER) AS ad_id,
         strftime(DATE '1960-01-01' + CAST(user_id % 14000 AS INTEGER), '%Y-%m-%d') AS birthday,
         'u' || user_id || '@mail.test' AS email, 'user' || user_id AS fullname, '-' AS iconurl,
         CASE WHEN event_id % 4 <> 0 THEN 'l' || event_id END AS lastlogin, '-' AS mailaddr,
         CAST(user_id % 8 + 1 AS VARCHAR) AS memberlevel, 'pw-field' AS password, '-' AS paymoney,
         '0170' || user_id AS phone, '44001' AS qq, ms AS register, '-' AS regupdatetime, '-' AS unitname,
         concat_ws('.', (event_id * 2654435 % 2147483647 >> 24) & 255, (event_id * 2654435 % 2147483647 >> 16) & 255,
                   (event_id * 2654435 % 2147483647 >> 8) & 255, event_id * 2654435 % 2147483647 & 255) AS userip,
         '-' AS zipcode, dt, dn, us // 1000 * 1000 AS us, event_id
  FROM ev WHERE event_type = 'signup'),
regtype_all AS (
  SELECT uid, 'k' || k AS appkey, 'http://reg' || event_id % 4 || '.test/' AS appregurl,
         CASE WHEN event_id % 3 <> 0 THEN 'b' || event_id END AS bdp_uuid, ms AS createtime, '-' AS isranreg,
         CAST(event_id % 5 AS VARCHAR) AS regsource, CAST(event_id % 4 AS VARCHAR) AS websiteid,
         dt, dn, us // 1000 * 1000 AS us, event_id
  FROM ev WHERE event_type = 'click'),
payment_all AS (
  SELECT uid, printf('%.2f', value) AS paymoney, CAST(event_id % 7 AS INTEGER) AS siteid,
         CAST(event_id % 6 AS INTEGER) AS vip_id, ms AS createtime, dt, dn, us // 1000 * 1000 AS us, event_id
  FROM ev WHERE event_type = 'purchase'),
website_log AS (
  SELECT CAST(event_id % 5 AS INTEGER) AS siteid, 'site' || k AS sitename, 'http://s' || k || '.test/' AS siteurl,
         CASE WHEN event_id % 5 = 0 THEN 'no' ELSE CAST(event_id % 2 AS VARCHAR) END AS "delete",
         '2000-01-01' AS createtime, 'c' || user_id AS creator, dn, us AS arrived, event_id AS "offset"
  FROM ev WHERE event_type = 'view'),
ad_log AS (
  SELECT CAST(event_id % 30 AS INTEGER) AS adid, 'ad' || k AS adname, dn, us AS arrived, event_id AS "offset"
  FROM ev WHERE event_type = 'error'),
vip_log AS (
  SELECT CAST(o_orderkey % 6 AS INTEGER) AS vip_id, o_orderpriority AS vip_level,
         strftime(o_orderdate, '%Y-%m-%d') || ' 00:00:00' AS start_time,
         strftime(o_orderdate, '%Y-%m-%d') || ' 23:59:59' AS end_time,
         CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') || ' 12:30:00'
              ELSE strftime(o_orderdate, '%Y-%m-%d') END AS last_modify_time,
         CAST(o_orderkey AS VARCHAR) AS max_free, '0' AS min_free, o_orderstatus AS next_level, 'op' AS operator,
         'web' || substr('ABC', CAST(o_custkey % 3 + 1 AS INTEGER), 1) AS dn,
         epoch_us(o_orderdate) AS arrived, o_orderkey AS "offset"
  FROM orders),
ads AS (SELECT n_nationkey AS adid, n_name AS adname, 'webA' AS dn FROM nation),
websites AS (
  SELECT CAST(s_suppkey % 5 AS INTEGER) AS siteid, s_name AS sitename, 'http://' || s_suppkey || '.test/' AS siteurl,
         '0' AS "delete", '2000-01-01' AS createtime, 'admin' AS creator,
         'web' || substr('ABC', CAST(s_suppkey // 5 % 3 + 1 AS INTEGER), 1) AS dn
  FROM supplier
  QUALIFY row_number() OVER (PARTITION BY s_suppkey % 5, s_suppkey // 5 % 3 ORDER BY s_suppkey DESC) = 1),
vips AS (
  SELECT r_regionkey AS vip_id, r_name AS vip_level, '2019-01-01 00:00:00' AS start_time,
         '2020-01-01 00:00:00' AS end_time, '2019-06-01 12:00:00' AS last_modify_time,
         'max' || r_regionkey AS max_free, 'min' || r_regionkey AS min_free, 'next' AS next_level,
         'op' AS operator, 'webA' AS dn
  FROM region)
"""
