"""Jobs: chains of operators that a user runs."""
