"""Column expressions; nothing here moves data between partitions."""
