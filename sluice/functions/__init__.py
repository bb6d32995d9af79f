"""Column functions: text, tokens and row order."""
