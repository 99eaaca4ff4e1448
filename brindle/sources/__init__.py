"""Readers and writers."""

from brindle.sources.readers import Matrix, read_csv, read_matrix, read_points, read_triples
from brindle.sources.writers import write_csv, write_tsv

__all__ = [
    "Matrix",
    "read_csv",
    "read_matrix",
    "read_points",
    "read_triples",
    "write_csv",
    "write_tsv",
]
