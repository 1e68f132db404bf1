"""Binds the engine's inputs to the benchmark tables, with the SQL each query must equal."""
