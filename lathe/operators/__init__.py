"""lathe.operators."""
