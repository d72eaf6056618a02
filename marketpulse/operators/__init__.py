"""Relational operators: snapshots, time series, cooldown, alerts, subscriptions, sentiment."""
