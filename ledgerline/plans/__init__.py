"""Query registry, oracle SQL, the end-to-end pipeline and plan checks."""
