"""Parsers of served bodies (HTML, feeds, PDF) and what is read from them. Each page is parsed once, in an Arrow batch."""
