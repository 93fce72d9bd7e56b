"""Column functions: numbers, time, text and geometry."""
