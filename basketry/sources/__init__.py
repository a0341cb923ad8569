"""Reading, checking and writing transaction lines."""
