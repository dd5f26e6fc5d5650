"""sievework: a Spark-native engine that builds and audits training data."""
