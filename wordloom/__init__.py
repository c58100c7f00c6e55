"""Text corpora to word counts, training samples and token embeddings, as Spark jobs."""
