"""Sources: change logs (topics or files) and column catalogs."""
