"""What to read and in which pieces: ranges, pages, symbols, predicates."""
