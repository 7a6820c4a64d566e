"""History files, relational and wide-column tables."""
