"""Whole jobs built from the operators."""

from custofold.plans.batch import BatchConfig, run
from custofold.plans.document import document_values, documents, fold_values, section_frames

__all__ = ["BatchConfig", "document_values", "documents", "fold_values", "run", "section_frames"]
