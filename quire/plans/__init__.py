"""Whole-document plans."""
