from .ingest import stage_stream

__all__ = ["stage_stream"]
