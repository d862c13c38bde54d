"""Named queries and end-to-end pipelines."""
