"""Complete layered builds put together from the operators."""
