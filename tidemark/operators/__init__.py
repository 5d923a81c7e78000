"""DataFrame to DataFrame operators; each takes its columns as parameters."""
