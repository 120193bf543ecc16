"""DataFrame -> DataFrame operators (lazy; nothing is collected)."""
