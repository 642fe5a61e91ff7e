"""Operators put together: pages to panel, panel to series, incremental runs."""
