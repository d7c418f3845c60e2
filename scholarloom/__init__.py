"""Scholarly-corpus analytics on Spark: documents in, audited Markdown tables out."""
