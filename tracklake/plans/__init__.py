"""Configuration, the staged pipeline, and its command line."""
