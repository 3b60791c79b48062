"""Sources and sinks: raw text files, layer tables, Parquet export."""
