"""creditloom: credit-risk features and scores as Spark jobs."""
