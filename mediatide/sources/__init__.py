"""Reading landed feeds, and reading and writing the stored tables."""
