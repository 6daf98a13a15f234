"""Citizen-complaint text analytics as Spark DataFrame operators."""
