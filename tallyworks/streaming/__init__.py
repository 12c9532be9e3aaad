from tallyworks.streaming.orders import redelivered_dropped, stream_bronze, stream_into_silver

__all__ = ["redelivered_dropped", "stream_bronze", "stream_into_silver"]
