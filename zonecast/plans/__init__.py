"""End-to-end plans: the ingest ETL and the dashboard query, as functions
of paths and parameters."""
