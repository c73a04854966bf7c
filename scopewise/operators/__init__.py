"""DataFrame operators over facts and metrics."""
