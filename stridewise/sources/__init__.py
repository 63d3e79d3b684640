"""Sources and sinks: delimited and XML export readers, Parquet/CSV writers, table loading."""
