"""Input schemas and the report sink."""
