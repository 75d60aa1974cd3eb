"""Record layouts, topics and where each topic goes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import DataType, IntegerType, LongType, StringType, StructField, StructType


_KINDS: dict[str, DataType] = {"": StringType(), "int": IntegerType(), "long": LongType()}


def _record(fields: str) -> StructType:
    """``name`` for a string field, ``name:int`` for a number."""
    pairs = [field.partition(":") for field in fields.split()]
    return StructType([StructField(name, _KINDS[kind]) for name, _, kind in pairs])


# Field names of the wire records, which the stored tables share.
RAW_LOG = _record("topic value")
ARRIVAL = _record("arrived:long offset:long")

MEMBER = _record(
    "uid:int ad_id:int birthday email fullname iconurl lastlogin mailaddr memberlevel "
    "password paymoney phone qq register regupdatetime unitname userip zipcode dt dn"
)
REGTYPE = _record("uid:int appkey appregurl bdp_uuid createtime isranreg regsource websiteid dt dn")
PAYMENT = _record("uid:int paymoney siteid:int vip_id:int createtime dt dn")
AD = _record("adid:int adname dn")
WEBSITE = _record("siteid:int sitename siteurl delete createtime creator dn")
VIP = _record(
    "vip_id:int vip_level start_time end_time last_modify_time max_free min_free "
    "next_level operator dn"
)
WIDE_MEMBER = _record(
    "uid:int ad_id:int birthday email fullname iconurl lastlogin mailaddr memberlevel "
    "password phone qq register regupdatetime unitname userip zipcode appkey appregurl "
    "bdp_uuid regtype_createtime isranreg regsource websiteid adname siteid:int sitename "
    "siteurl site_createtime paymoney vip_id:int vip_level vip_start_time vip_end_time "
    "last_modify_time max_free min_free next_level operator dn dt"
)

# Topic names.
MEMBER_TOPIC = "member"
REGTYPE_TOPIC = "memberregtype"
PAYMENT_TOPIC = "memberpaymoney"
AD_TOPIC = "basead"
WEBSITE_TOPIC = "basewebsite"
VIP_TOPIC = "membervip"
FACT_TOPICS = (MEMBER_TOPIC, REGTYPE_TOPIC, PAYMENT_TOPIC)
DIMENSION_TOPICS = (AD_TOPIC, WEBSITE_TOPIC, VIP_TOPIC)
SECOND_LAYER_PREFIX = "dwd"

MEMBER_KEY = ("uid", "dn")


@dataclass(frozen=True)
class Dimension:
    """One dimension table: its name, layout and business key."""

    table: str
    schema: StructType
    key: tuple[str, ...]


AD_TABLE = Dimension("dwd_basead", AD, ("adid", "dn"))
WEBSITE_TABLE = Dimension("dwd_basewebsite", WEBSITE, ("siteid", "dn"))
VIP_TABLE = Dimension("dwd_membervip", VIP, ("vip_id", "dn"))

# A dimension record of any other topic is taken for a VIP record.
DIMENSION_ROUTES = {WEBSITE_TOPIC: WEBSITE_TABLE, AD_TOPIC: AD_TABLE}
DEFAULT_ROUTE = VIP_TABLE
DIMENSIONS = (AD_TABLE, WEBSITE_TABLE, VIP_TABLE)


def wire_schema(schema: StructType) -> StructType:
    """The same fields, all as strings: producers send ids as JSON strings."""
    return StructType([StructField(field.name, StringType()) for field in schema])
