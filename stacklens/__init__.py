"""Patron analytics and book recommendation on Spark."""
