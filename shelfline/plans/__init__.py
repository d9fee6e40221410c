"""Composed plans: scenario frames, registered queries, oracle SQL, the daily run."""
