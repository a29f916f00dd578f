"""The incremental loads as a stream."""
