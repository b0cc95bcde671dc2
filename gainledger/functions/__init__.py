"""Column helpers shared by every rule."""
