"""DataFrame -> DataFrame operators."""
