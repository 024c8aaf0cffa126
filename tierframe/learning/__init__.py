"""Training and scoring as MLlib jobs."""
