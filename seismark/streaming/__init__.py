from seismark.streaming.incremental import incremental_append, incremental_load

__all__ = ["incremental_append", "incremental_load"]
