"""Streaming: file arrival in a feed's landing folder triggers the yearly load."""

from vaultspark.streaming.landing import touched_years, watch_feed

__all__ = ["touched_years", "watch_feed"]
