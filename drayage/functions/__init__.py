"""Column functions used by the connectors."""
