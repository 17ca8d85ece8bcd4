"""DataFrame operators over the long feed table and the wide fact table."""
