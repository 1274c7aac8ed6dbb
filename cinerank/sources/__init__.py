"""Sources: domain schemas, text/CSV loaders, table I/O, fixture views."""
