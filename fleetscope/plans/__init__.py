"""The recurring runs, put together from the operators."""
