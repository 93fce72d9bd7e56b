"""The same operators on streams of readings."""
