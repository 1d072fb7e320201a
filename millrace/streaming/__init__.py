from millrace.streaming.landing import stream_landing
from millrace.streaming.silver import stream_silver

__all__ = ["stream_landing", "stream_silver"]
