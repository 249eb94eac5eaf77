"""Question plans, the query registry and oracle SQL."""
