"""Monitoring of content changes on a website, as Spark DataFrame operators."""
