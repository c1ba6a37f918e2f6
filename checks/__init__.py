"""Checks of the plans over the given tables: derived inputs, registered queries, oracle SQL."""
