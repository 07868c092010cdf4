"""Whole jobs (bronze, silver, gold) and the report and dashboard tables."""
