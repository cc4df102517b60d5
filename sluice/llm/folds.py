"""Folds by document id."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def in_fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id is in fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds, F.lit(0))
