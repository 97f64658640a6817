"""Builds composed of operators: dimensions, facts, marts, whole runs."""
