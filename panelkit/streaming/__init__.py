from panelkit.streaming.clean_stream import clean_stream, stream_to_table

__all__ = ["clean_stream", "stream_to_table"]
