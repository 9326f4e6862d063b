"""Landed payload files: tab-separated reports, visit logs, JSON pages, credential files."""
