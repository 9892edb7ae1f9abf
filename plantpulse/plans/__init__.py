"""Compositions of operators: silver, gold, training and monitoring."""
