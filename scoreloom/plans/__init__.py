"""End-to-end plans put together from the operators."""
