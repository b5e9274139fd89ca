"""DataFrame operators on claims and on tables."""
