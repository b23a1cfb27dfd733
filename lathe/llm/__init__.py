"""Training-data operators (dedup, filtering, mixing, packing); nothing else in the library imports them."""
