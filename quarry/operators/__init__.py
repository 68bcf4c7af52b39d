"""DataFrame -> DataFrame operators (sampling, statistics, scoring, metrics...)."""
