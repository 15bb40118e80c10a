"""DataFrame -> DataFrame operators (no actions unless a docstring says so)."""
