"""Table adapters (test tables -> the reference's input shapes), readers and writers."""

from affinity.sources import tables, readers, writers

__all__ = ["tables", "readers", "writers"]
