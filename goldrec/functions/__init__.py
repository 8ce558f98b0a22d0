"""goldrec."""
