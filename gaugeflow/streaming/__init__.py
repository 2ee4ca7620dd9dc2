from gaugeflow.streaming.drain import drain, drain_counts, drain_total
from gaugeflow.streaming.ingest import stream_to_table
from gaugeflow.streaming.publish import stream_to_topic
from gaugeflow.streaming.reports import (
    RECEIVED,
    REPORT,
    read_report,
    sql_report,
    stream_reports,
)

__all__ = [
    "RECEIVED",
    "REPORT",
    "drain",
    "drain_counts",
    "drain_total",
    "read_report",
    "sql_report",
    "stream_reports",
    "stream_to_table",
    "stream_to_topic",
]
