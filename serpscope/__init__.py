"""Search-interaction analytics as plain DataFrame -> DataFrame functions."""
