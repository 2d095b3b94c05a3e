"""Writers: CSV, relational (JDBC), dated report partitions, outbox."""
