"""Composed plans: the batch flow, the query registry and the oracle SQL."""
