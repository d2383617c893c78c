"""Incremental versions of the layered load."""

from agoralake.streaming.incremental import (
    stream_gold,
    stream_layers,
    stream_quarantine,
    stream_silver,
)

__all__ = ["stream_gold", "stream_layers", "stream_quarantine", "stream_silver"]
