"""Discovery of new drops as a stream."""
