"""lathe.functions."""
