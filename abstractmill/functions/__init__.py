"""Column-level building blocks: ``Column -> Column``, no actions, no driver state."""
