from lakevault.streaming.snapshots import customer_snapshot_stream, snapshot_stream

__all__ = ["customer_snapshot_stream", "snapshot_stream"]
