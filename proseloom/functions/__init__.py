"""See README."""
