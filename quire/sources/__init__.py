"""Transcripts, PDF pages and glyphs, the OCR seam, and image sinks."""
