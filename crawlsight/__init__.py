"""Crawl-run analytics as Spark jobs."""
