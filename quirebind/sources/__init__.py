"""Reading documents and messages, writing and reading results."""
