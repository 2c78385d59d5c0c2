"""DataFrame operators on time-series tables."""
