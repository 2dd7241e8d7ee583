"""Post analytics on Spark: cleaning, trends, sentiment, topics and user activity as DataFrame operators."""
