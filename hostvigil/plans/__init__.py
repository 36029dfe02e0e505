"""Complete queries built from the operators."""
