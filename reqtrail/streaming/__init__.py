from reqtrail.streaming.snapshots import TableStore, apply_snapshots

__all__ = ["TableStore", "apply_snapshots"]
