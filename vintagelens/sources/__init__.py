"""Feeds, snapshot tables, the calendar and the tables derived from the test data."""
