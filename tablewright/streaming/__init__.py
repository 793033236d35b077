"""Tables kept up to date from streams: Structured Streaming, published batch by batch."""

from .apply import apply_stream
from .late import LateRows, late_rows
from .versions import closed_once, version_stream
from .windows import window_counts

__all__ = ["LateRows", "apply_stream", "closed_once", "late_rows", "version_stream", "window_counts"]
