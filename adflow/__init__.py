"""adflow: advertising analytics as plain Spark jobs (batch and streaming)."""

__version__ = "0.1.0"
