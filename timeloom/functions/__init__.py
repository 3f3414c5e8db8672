"""Functions of the timeline engine."""
