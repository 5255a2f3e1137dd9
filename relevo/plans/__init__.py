"""Feature sets and scoring flows assembled from sources/functions/operators."""
