"""compoundry: Spark-native enrichment of a product catalog with compound data."""
