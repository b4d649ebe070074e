"""Compositions of operators: analytic models, the batch run and the query catalog."""
