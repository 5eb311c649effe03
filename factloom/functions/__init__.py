"""factloom package."""
