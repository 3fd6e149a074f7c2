"""DataFrame operators over pages, blocks, relations and usage events."""
