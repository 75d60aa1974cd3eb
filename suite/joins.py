"""Checks of joins, lookups and the wide row."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from rollcall.operators import joins as op
from rollcall.operators.lookup import (
    dead_letters, lookup_ad, lookup_all, lookup_by_client, lookup_vip, lookup_website, missed_lookups,
)
from rollcall.operators.projection import (
    MEMBER_COLUMNS, blank_fill, wide_row, with_member_key, without_member_amount,
)
from rollcall.operators.skew import HotKeys
from rollcall.plans.member_wide import current_members, wide_rows
from rollcall.schemas import WIDE_MEMBER

from . import views
from .registry import check
from .views import DAY, names

_DAY_US = 86_400_000_000


def _flat(df: DataFrame) -> DataFrame:
    return df.withColumn("win_us", F.unix_micros("win.start")).drop("win", "member_tie", "regtype_tie", "payment_tie")


def _flags(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("int") for c in ("ad_hit", "site_hit", "vip_hit") if c in df.columns})


def jn1_sql(window_us: int, squeeze: int = 1) -> str:
    us = f"({views.BEGIN_US} + (us - {views.BEGIN_US}) // {squeeze})"
    return f"""
m AS (SELECT {names('member', 'paymoney')}, {us} AS member_us, {us} // {window_us} * {window_us} AS win_us FROM member_all),
r AS (SELECT uid, dn, appkey, appregurl, bdp_uuid, createtime AS regtype_createtime, isranreg, regsource, websiteid,
             {us} AS regtype_us, {us} // {window_us} * {window_us} AS win_us FROM regtype_all),
jn1 AS (SELECT m.*, r.* EXCLUDE (uid, dn, win_us) FROM m LEFT JOIN r USING (uid, dn, win_us))"""


JN2 = f"""
p AS (SELECT uid, dn, paymoney, siteid, vip_id, us AS payment_us, us // {_DAY_US} * {_DAY_US} AS win_us FROM payment_all),
jn2 AS (SELECT jn1.*, p.* EXCLUDE (uid, dn, win_us) FROM jn1 LEFT JOIN p USING (uid, dn, win_us))"""

DIMS = """
d_ad AS (SELECT adid AS ad_id, dn, adname, TRUE AS ad_found FROM ads),
d_site AS (SELECT siteid, dn, sitename, siteurl, "delete", createtime AS site_createtime, creator AS site_creator,
                  TRUE AS site_found FROM websites),
d_vip AS (SELECT vip_id, dn, vip_level, start_time AS vip_start_time, end_time AS vip_end_time, last_modify_time,
                 max_free, min_free, next_level, operator, TRUE AS vip_found FROM vips)"""

JN6 = DIMS + """,
jn6 AS (SELECT jn2.*, d_ad.* EXCLUDE (ad_id, dn, ad_found), d_site.* EXCLUDE (siteid, dn, site_found),
               d_vip.* EXCLUDE (vip_id, dn, vip_found),
               CAST(coalesce(ad_found, FALSE) AS INTEGER) AS ad_hit, CAST(coalesce(site_found, FALSE) AS INTEGER) AS site_hit,
               CAST(coalesce(vip_found, FALSE) AS INTEGER) AS vip_hit
        FROM jn2 LEFT JOIN d_ad USING (ad_id, dn) LEFT JOIN d_site USING (siteid, dn) LEFT JOIN d_vip USING (vip_id, dn))"""

WIDE = ", ".join(f'"{n}"' for n in WIDE_MEMBER.fieldNames())


@check("jn1_member_regtype", f"WITH {jn1_sql(_DAY_US)} SELECT * FROM jn1")
def jn1(spark, sf_dir):
    member, regtype, _ = views.facts(spark, sf_dir)
    return _flat(op.join_regtype(member, regtype, size=DAY))


@check("jn1_hot_keys_spread", f"WITH {jn1_sql(_DAY_US)} SELECT * FROM jn1")
def jn1_spread(spark, sf_dir):
    """The same with every key of more than one row dealt out."""
    member, regtype, _ = views.facts(spark, sf_dir)
    return _flat(op.join_regtype(member, regtype, size=DAY, hot_keys=HotKeys(rows_per_part=1)))


@check("jn1_ten_minutes", f"WITH {jn1_sql(600_000_000, 144)} SELECT * FROM jn1")
def jn1_ten_minutes(spark, sf_dir):
    """A day of the events in ten minutes, so that many windows hold both sides."""
    member, regtype, _ = views.facts(spark, sf_dir, squeeze=144)
    return _flat(op.join_regtype(member, regtype))


@check("jn2_member_payment", f"WITH {jn1_sql(_DAY_US)}, {JN2} SELECT * FROM jn2")
def jn2(spark, sf_dir):
    member, regtype, payment = views.facts(spark, sf_dir)
    return _flat(op.join_payment(op.join_regtype(member, regtype, size=DAY), payment, size=DAY, counted=member))


@check("jn2_chain_spread", f"WITH {jn1_sql(_DAY_US)}, {JN2} SELECT * FROM jn2")
def jn2_chain(spark, sf_dir):
    """Both joins in one chain, with keys dealt out over all three sides."""
    member, regtype, payment = views.facts(spark, sf_dir)
    return _flat(op.join_member_facts(member, regtype, payment, size=DAY, hot_keys=HotKeys(rows_per_part=1)))


@check("jn3_ad_lookup", f"""WITH {DIMS}
SELECT {names('member')}, adname, CAST(coalesce(ad_found, FALSE) AS INTEGER) AS ad_hit
FROM member_all LEFT JOIN d_ad USING (ad_id, dn)""")
def jn3(spark, sf_dir):
    member, _, _ = views.facts(spark, sf_dir)
    return _flags(lookup_ad(member, views.ads(spark, sf_dir))).drop("ts")


@check("jn4_website_lookup", f"""WITH {DIMS}
SELECT {names('payment')}, d_site.* EXCLUDE (siteid, dn, site_found), CAST(coalesce(site_found, FALSE) AS INTEGER) AS site_hit
FROM payment_all LEFT JOIN d_site USING (siteid, dn)""")
def jn4(spark, sf_dir):
    _, _, payment = views.facts(spark, sf_dir)
    return _flags(lookup_website(payment, views.websites(spark, sf_dir))).drop("ts")


@check("jn5_vip_lookup", f"""WITH {DIMS}
SELECT {names('payment')}, d_vip.* EXCLUDE (vip_id, dn, vip_found), CAST(coalesce(vip_found, FALSE) AS INTEGER) AS vip_hit
FROM payment_all LEFT JOIN d_vip USING (vip_id, dn)""")
def jn5(spark, sf_dir):
    _, _, payment = views.facts(spark, sf_dir)
    return _flags(lookup_vip(payment, views.vips(spark, sf_dir))).drop("ts")


def _enriched(spark, sf_dir):
    joined = op.join_member_facts(*views.facts(spark, sf_dir), size=DAY)
    return lookup_all(joined, *views.dimensions(spark, sf_dir))


@check("jn6_all_lookups", f"WITH {jn1_sql(_DAY_US)}, {JN2}, {JN6} SELECT * FROM jn6")
def jn6(spark, sf_dir):
    return _flat(_flags(_enriched(spark, sf_dir)))


@check("jn7_dead_letters", f"""WITH {jn1_sql(_DAY_US)}, {JN2}, {JN6}
SELECT * FROM (
  SELECT uid, dn, ad_id, siteid, vip_id,
         concat_ws(',', CASE WHEN ad_hit = 0 THEN 'ad' END, CASE WHEN siteid IS NOT NULL AND site_hit = 0 THEN 'site' END,
                   CASE WHEN vip_id IS NOT NULL AND vip_hit = 0 THEN 'vip' END) AS missed
  FROM jn6) WHERE missed <> ''""")
def jn7(spark, sf_dir):
    return dead_letters(_enriched(spark, sf_dir))


@check("jn7_lookup_status", f"""WITH {jn1_sql(_DAY_US)}, {JN2}, {JN6}
SELECT ad_hit, site_hit, vip_hit,
       concat_ws(',', CASE WHEN ad_hit = 0 THEN 'ad' END, CASE WHEN siteid IS NOT NULL AND site_hit = 0 THEN 'site' END,
                 CASE WHEN vip_id IS NOT NULL AND vip_hit = 0 THEN 'vip' END) AS missed, count(*) AS n
FROM jn6 GROUP BY ALL""")
def jn7_status(spark, sf_dir):
    flagged = _enriched(spark, sf_dir).withColumn("missed", missed_lookups())
    return _flags(flagged.groupBy("ad_hit", "site_hit", "vip_hit", "missed").agg(F.count("*").alias("n")))


@check("jn8_small_window", f"WITH {jn1_sql(10_000_000, 8640)} SELECT * FROM jn1")
def jn8(spark, sf_dir):
    """A day of the events in ten seconds."""
    member, regtype, _ = views.facts(spark, sf_dir, squeeze=8640)
    return _flat(op.join_regtype(member, regtype, size=op.SMALL_WINDOW))


_COGROUPED = StructType([
    StructField("uid", StringType()), StructField("dn", StringType()), StructField("register", StringType()),
    StructField("appkey", StringType()), StructField("createtime", StringType()),
])


@check("jn9_cogroup", """
SELECT CAST(m.uid AS VARCHAR) AS uid, m.dn, register, appkey, createtime
FROM member_all m LEFT JOIN regtype_all r
  ON m.uid = r.uid AND m.dn = r.dn AND m.us // 86400000000 = r.us // 86400000000""")
def jn9(spark, sf_dir):
    member, regtype, _ = views.facts(spark, sf_dir)
    uid = F.col("uid").cast("string").alias("uid")
    left = _flat(op.in_window(member, "ts", DAY)).select(uid, "dn", "win_us", "register")
    right = _flat(op.in_window(regtype, "ts", DAY)).select(uid, "dn", "win_us", "appkey", "createtime")

    def left_pairs(l: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        both = l.merge(r, on=["uid", "dn", "win_us"], how="left")
        return both[["uid", "dn", "register", "appkey", "createtime"]].astype(object).where(lambda c: c.notna(), None)

    return op.cogroup(left, right, ["uid", "dn", "win_us"], left_pairs, _COGROUPED,
                      HotKeys(rows_per_part=2), rows_per_call=20_000)


@check("jn10_wide_rows", f"WITH {jn1_sql(_DAY_US)}, {JN2}, {JN6} SELECT {WIDE}, ad_hit, site_hit, vip_hit FROM jn6")
def jn10(spark, sf_dir):
    return _flags(wide_rows(*views.facts(spark, sf_dir), *views.dimensions(spark, sf_dir), size=DAY))


@check("jn10_wide_rows_spread", f"WITH {jn1_sql(_DAY_US)}, {JN2}, {JN6} SELECT {WIDE}, ad_hit, site_hit, vip_hit FROM jn6")
def jn10_spread(spark, sf_dir):
    hot_keys = HotKeys(rows_per_part=1)
    return _flags(wide_rows(*views.facts(spark, sf_dir), *views.dimensions(spark, sf_dir), size=DAY, hot_keys=hot_keys))


def last_values_sql(source: str, order: str, columns: list[str], keys: str = "uid, dn") -> str:
    picks = ", ".join(
        f'arg_max("{c}", {order}) FILTER (WHERE "{c}" IS NOT NULL) AS "{c}"' for c in columns)
    return f"SELECT {keys}, {picks} FROM {source} GROUP BY {keys}"


STORED = f'{WIDE}, "delete", site_creator'
MERGED = [n for n in (*WIDE_MEMBER.fieldNames(), "delete", "site_creator") if n not in ("uid", "dn")]
PAIR_ORDER = "ROW(member_us, coalesce(regtype_us, 0), coalesce(payment_us, 0))"


@check("jn10_current_members", f"""WITH {jn1_sql(_DAY_US)}, {JN2}, {JN6},
merged AS ({last_values_sql('jn6', PAIR_ORDER, MERGED)})
SELECT substr(md5(CAST(uid AS VARCHAR)), 1, 5) || uid || dn AS row_key, {STORED} FROM merged""")
def jn10_current(spark, sf_dir):
    """The wide table after all upserts; the SQL side forms the pairs, the Spark side does not."""
    return current_members(*views.facts(spark, sf_dir), *views.dimensions(spark, sf_dir), size=DAY)


@check("prj2_flat_row", f"WITH {jn1_sql(_DAY_US)} SELECT {names('member', 'paymoney')}, appkey, appregurl, regtype_createtime FROM jn1")
def prj2(spark, sf_dir):
    member, regtype, _ = views.facts(spark, sf_dir)
    return op.join_regtype(member, regtype, size=DAY).select(
        *MEMBER_COLUMNS, "appkey", "appregurl", "regtype_createtime")


@check("prj3_member_key", "SELECT uid, dn, uid || '_' || dn AS member_key FROM member_all")
def prj3(spark, sf_dir):
    member, _, _ = views.facts(spark, sf_dir)
    return with_member_key(member.select("uid", "dn"))


@check("prj4_blank_fill", f"""WITH {jn1_sql(_DAY_US)}, {JN2}
SELECT uid, dn, register, coalesce(appkey, '') AS appkey, coalesce(bdp_uuid, '') AS bdp_uuid,
       coalesce(paymoney, '') AS paymoney, coalesce(CAST(siteid AS VARCHAR), '') AS siteid,
       coalesce(CAST(vip_id AS VARCHAR), '') AS vip_id FROM jn2""")
def prj4(spark, sf_dir):
    joined = op.join_member_facts(*views.facts(spark, sf_dir), size=DAY)
    blank = ["appkey", "bdp_uuid", "paymoney", "siteid", "vip_id"]
    return blank_fill(joined, blank).select("uid", "dn", "register", *blank)


@check("prj9_wide_row", f"""WITH {jn1_sql(_DAY_US)}, {JN2}, {JN6}
SELECT * REPLACE (regexp_replace(regexp_replace(email, '[a-z]', 'x', 'g'), '[0-9]', 'n', 'g') AS email)
FROM (SELECT {WIDE} FROM jn6)""")
def prj9(spark, sf_dir):
    return wide_row(_enriched(spark, sf_dir), mask=["email"])


@check("prj10_without_amount", f"SELECT {names('member', 'paymoney')} FROM member_all")
def prj10(spark, sf_dir):
    member, _, _ = views.facts(spark, sf_dir)
    return without_member_amount(member).drop("ts")


@check("udf5_lookup_by_client", """
SELECT m.uid, m.dn, register, CASE WHEN ad_id % 5 <> 0 THEN ad_id END AS ad_id, CASE WHEN ad_id % 5 <> 0 THEN adname END AS adname,
       user_id * 9007199254740 + 1 AS big, CASE WHEN ad_id = 7 THEN 'ValueError: no answer for 7' END AS lookup_error
FROM member_all m JOIN (SELECT event_id, user_id FROM ev) e USING (event_id) LEFT JOIN (SELECT * FROM ads WHERE adid <> 7) a ON m.ad_id = a.adid AND m.dn = a.dn""")
def udf5(spark, sf_dir):
    """The given ads behind a client that is asked by key and fails for one of them; some rows have no key."""
    store = {(r.adid, r.dn): {"adname": r.adname} for r in views.ads(spark, sf_dir).collect()}  # 25 rows in every size

    def fetch(client: dict, wanted: list[tuple]) -> dict[tuple, dict]:
        if any(key[0] == 7 for key in wanted):
            raise ValueError("no answer for 7")
        return {key: client[key] for key in wanted if key in client}

    rows = views.member(views.events(spark, sf_dir).withColumn("user", F.col("user_id"))).selectExpr(
        "uid", "dn", "register", "IF(ad_id % 5 = 0, NULL, ad_id) AS ad_id", "CAST(uid AS bigint) * 9007199254740 + 1 AS big")
    asked = StructType([StructField("adname", StringType())])
    # The failing key in requests of its own, so that the others get their answers.
    sides = [lookup_by_client(rows.where(part), lambda: store, fetch, ["ad_id", "dn"], asked)
             for part in ("ad_id = 7", "ad_id <> 7 OR ad_id IS NULL")]
    return sides[0].unionByName(sides[1])


@check("udf3_cogroup_whole_groups", """
WITH l AS (SELECT uid, count(*) AS members FROM member_all GROUP BY uid),
r AS (SELECT uid, count(*) AS regtypes FROM regtype_all GROUP BY uid)
SELECT CAST(coalesce(l.uid, r.uid) AS BIGINT) AS uid, coalesce(members, 0) AS members, coalesce(regtypes, 0) AS regtypes
FROM l FULL JOIN r ON l.uid = r.uid""")
def udf3(spark, sf_dir):
    """Any function over both sides; rows are counted per key first, so groups are small."""
    member, regtype, _ = views.facts(spark, sf_dir)
    left = member.groupBy("uid").agg(F.count("*").alias("n"))
    right = regtype.groupBy("uid").agg(F.count("*").alias("n"))

    def both(l: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        uid = (l if len(l) else r)["uid"].iloc[0]
        return pd.DataFrame({"uid": [uid], "members": [l["n"].sum()], "regtypes": [r["n"].sum()]})

    return op.cogroup(left, right, ["uid"], both, "uid bigint, members bigint, regtypes bigint", hot_keys=None)
