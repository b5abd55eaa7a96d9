"""Subscription revenue, retention and risk analytics as Spark DataFrame jobs."""
