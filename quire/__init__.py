"""quire: a Spark-native engine that turns pages of text into a retrieval-ready corpus."""
