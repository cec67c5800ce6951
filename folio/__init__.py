"""Folio: document-structure analytics as Spark DataFrame transforms."""
