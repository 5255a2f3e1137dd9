"""Relational building blocks (joins, aggregation, TF-IDF, vectors, k-NN, order)."""
