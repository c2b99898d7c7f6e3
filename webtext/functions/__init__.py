"""Column functions: URLs, HTML, text, document identity."""
