"""Compositions of operators, the views used by the checks, and the catalogue of queries."""
