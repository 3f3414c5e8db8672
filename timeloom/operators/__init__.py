"""Operators of the timeline engine."""
