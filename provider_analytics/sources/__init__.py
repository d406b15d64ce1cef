"""Input schemas, readers and the dataset registry."""
