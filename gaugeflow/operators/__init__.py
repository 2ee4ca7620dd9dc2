from gaugeflow.operators.alerts import low_pressure, sample_alert
from gaugeflow.operators.preview import first_rows, show
from gaugeflow.operators.reports import (
    avg_psi,
    reading_count,
    received_count,
    sensor_day_report,
)
from gaugeflow.operators.stats import (
    avg_psi_by_day,
    daily_stats,
    sensor_rows,
    stats_cells,
)
from gaugeflow.operators.views import sensor_row_sql, sensor_sql
from gaugeflow.operators.wide_table import WideTable

__all__ = [
    "WideTable",
    "avg_psi",
    "avg_psi_by_day",
    "daily_stats",
    "first_rows",
    "low_pressure",
    "reading_count",
    "received_count",
    "sample_alert",
    "sensor_day_report",
    "sensor_row_sql",
    "sensor_rows",
    "sensor_sql",
    "show",
    "stats_cells",
]
