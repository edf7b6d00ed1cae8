"""Rules over block text, inline rendering, glyph geometry and pixels."""
