"""Column helpers shared by every model."""
