"""Sources and sinks: fixed CSV schemas, the table bundle, stand-in views."""

from footfall.sources.tables import (Tables, read_csv, read_csv_tables,
                                     read_submission_ids, write_csv,
                                     write_snapshot)

__all__ = ["Tables", "read_csv", "read_csv_tables", "read_submission_ids",
           "write_csv", "write_snapshot"]
