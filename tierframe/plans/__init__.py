"""Feature plans: operators put together for the three-level data set."""
