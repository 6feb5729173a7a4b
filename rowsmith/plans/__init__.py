"""Operators put together: the quality report of tables, the repair of tables, the page search."""
