"""Relational operators over pages, blocks, tables, boxes and glyphs."""
