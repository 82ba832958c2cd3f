"""DataFrame -> DataFrame operators: normalisation, loads, checks, profiles."""
