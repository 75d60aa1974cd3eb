from .client_sink import Client, client_sink
from .console import show_on_console
from .topic_log import append_facts, topic_stream, write_text_topic, write_topic_log
from .upsert_table import CellTable, UpsertTable

__all__ = [
    "CellTable", "Client", "UpsertTable", "append_facts", "client_sink", "show_on_console", "topic_stream", "write_text_topic", "write_topic_log",
]
