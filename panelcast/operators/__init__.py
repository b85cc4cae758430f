"""Panel operators, each DataFrame -> DataFrame."""
