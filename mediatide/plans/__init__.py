"""Models in their order, and the batch jobs."""
