"""Composed jobs: the flagship moderation plan, the registered query catalogue and its DuckDB oracle SQL."""
