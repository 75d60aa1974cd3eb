from .ids import composite_key, md5_hex, salted_row_key
from .json import is_json_object, json_field, json_object, json_text
from .text import ipv4, money_text, target_topic, to_bytes, to_text
from .time import epoch_ms_to_timestamp, parse_datetime, partition_date

__all__ = [
    "composite_key", "epoch_ms_to_timestamp", "ipv4", "is_json_object", "json_field",
    "json_object", "json_text", "md5_hex", "money_text", "parse_datetime",
    "partition_date", "salted_row_key", "target_topic", "to_bytes", "to_text",
]
