"""Column functions and code sets."""
