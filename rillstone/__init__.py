"""Config-driven ingest of JSON message topics into keyed tables, on PySpark."""
