"""lathe.streaming."""
