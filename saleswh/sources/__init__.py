"""Sources and sinks: bridge tables, OData pages, ingest, exports."""
