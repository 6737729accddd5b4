"""Sources and sinks: driver tables, files, Kafka."""
from .files import (  # noqa: F401
    label_table, one_row, read_label_dictionary, read_traffic_csv, timestamped_name,
    write_csv, write_json, write_timestamped_csv,
)
from .fixtures import load  # noqa: F401
