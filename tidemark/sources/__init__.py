"""Reading, writing and generating data."""
