"""Writers: Kafka JSON records, partitioned ORC fact table, compaction."""
