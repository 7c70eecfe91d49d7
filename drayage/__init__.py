"""Drayage: connectors and data movement as ordinary Spark jobs.

Raw responses land in a table, Catalyst expressions shape them into typed rows, and rows
leave as batched, replay-safe requests.  ``read``, ``write``, ``read_stream``, ``poll_stream``,
``write_stream`` and ``send_stream`` give every connector by name.
"""

from drayage.registry import poll_stream, read, read_stream, register, send_stream, write, write_stream

__all__ = ["poll_stream", "read", "read_stream", "register", "send_stream", "write", "write_stream"]
