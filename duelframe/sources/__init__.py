"""Sources and sinks: driver tables, the contest fixture, CSV/parquet/JSON."""
