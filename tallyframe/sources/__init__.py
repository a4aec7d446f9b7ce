"""Readers: typed CSV files and tables embedded in crawled HTML pages."""
