"""Steps that take up new files as they come."""

from custofold.streaming.staging import stage_new_files

__all__ = ["stage_new_files"]
