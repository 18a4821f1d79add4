"""Message schemas, topic envelopes and parquet tables."""
