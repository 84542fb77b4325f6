"""Column functions: identifiers, text, vectors."""
