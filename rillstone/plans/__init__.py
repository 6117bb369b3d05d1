"""Tables and whole ingest runs, composed from the operators."""
