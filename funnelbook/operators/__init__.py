"""DataFrame operators for all clients at once. All are lazy: none runs an action."""
