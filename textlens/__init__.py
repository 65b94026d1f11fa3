"""Text mining of scored reviews as Spark DataFrame transformations."""
