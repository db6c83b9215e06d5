"""Clinical risk scores."""
