"""Training-data operators. Nothing outside this package imports it; it can be deleted as a whole."""
