"""Writers: rows to requests in an outbox, and rows to files."""
