"""Query plans: fixture views over the driver tables, named queries and their oracles."""
