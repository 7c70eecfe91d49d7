"""Distributed building blocks shared by the connectors."""
