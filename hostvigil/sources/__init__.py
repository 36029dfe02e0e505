"""Reading wide CSV files, landed tables, Kafka topics and event tables."""
