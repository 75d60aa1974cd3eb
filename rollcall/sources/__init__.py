from .dimensions import ad_dimension, vip_dimension, website_dimension
from .jdbc import jdbc_query, render_sql
from .raw_log import kafka_options, read_lines, read_raw_log
from .typed import decode, member_records, payment_records, regtype_records

__all__ = [
    "ad_dimension", "decode", "jdbc_query", "kafka_options", "member_records",
    "payment_records", "read_lines", "read_raw_log", "regtype_records", "render_sql",
    "vip_dimension", "website_dimension",
]
