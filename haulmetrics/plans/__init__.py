"""The analytics stages, each a function from DataFrame to DataFrame."""
