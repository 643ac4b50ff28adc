"""siltstone: a Spark-native engine that builds and audits training corpora."""
