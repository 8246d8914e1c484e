"""DataFrame operators. Each takes a DataFrame and returns one, so they chain with `.transform`."""
