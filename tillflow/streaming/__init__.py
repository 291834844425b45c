"""Sinks, triggers and starting of streaming queries."""
