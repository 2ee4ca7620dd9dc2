from gaugeflow.functions.keys import day_key, record_key, row_key
from gaugeflow.functions.parsing import parse_sensor

__all__ = ["day_key", "parse_sensor", "record_key", "row_key"]
