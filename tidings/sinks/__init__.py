"""Writers: partitioned files, exports and upserted index tables."""
