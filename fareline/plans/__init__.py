"""Compositions of operators: conforming a month, models and marts, the monthly run."""
