"""Composed plans: the enrichment pipeline and its SQL form."""

from .enrichment import PipelineOptions, process, process_split
from .sql import enrich_sql, enrich_sql_text, insert_into, insert_into_keyed

__all__ = ["PipelineOptions", "enrich_sql", "enrich_sql_text", "insert_into", "insert_into_keyed", "process", "process_split"]
