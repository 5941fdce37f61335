"""Message schemas, stream and archive readers, and JSON parsers."""
