"""Domain declarations and whole runs."""
