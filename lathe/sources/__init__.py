"""lathe.sources."""
