from .incremental import ingest_incremental, new_rows
from .merge import CurrentRows, refresh_partitions

__all__ = ["CurrentRows", "ingest_incremental", "new_rows", "refresh_partitions"]
