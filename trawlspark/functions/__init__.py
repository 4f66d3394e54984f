"""Column functions: text, URLs, vectors, tokens, ids."""
