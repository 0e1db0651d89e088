"""Runnable plans: the query catalogue with its SQL oracles, and the argument-driven jobs."""
