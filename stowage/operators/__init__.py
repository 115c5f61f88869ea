"""DataFrame operators behind the store."""
