"""Models composed of the operators; every function returns a lazy DataFrame."""
