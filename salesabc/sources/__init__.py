"""Readers: sales sheets, order pages, catalogues, settlement reports, Markdown."""
