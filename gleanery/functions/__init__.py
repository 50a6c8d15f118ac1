"""Column functions: text, typing and packed lists."""
