"""Column-level building blocks: no function here triggers a job or needs a shuffle."""
