"""Regressors: Spark ML estimators where one exists, driver-loop ensembles and
gradient harnesses (one Spark job per round) where none does."""
