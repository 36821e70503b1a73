"""Statement files as a stream: another way in, beside the batch ingest."""
