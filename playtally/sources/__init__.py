"""Sources: message tables, Kafka, log folders, JDBC."""
