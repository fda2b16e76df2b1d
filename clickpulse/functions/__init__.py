"""Column functions, all composed of built-ins."""
