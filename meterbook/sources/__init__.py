"""Source tables: declared schemas, readers, feed windows and a sample derived from order data."""
