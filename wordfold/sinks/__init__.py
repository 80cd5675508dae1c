"""Sinks."""

from wordfold.sinks.text import write_text

__all__ = ["write_text"]
