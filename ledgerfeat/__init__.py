"""Account-level risk features and default scoring on Spark."""
