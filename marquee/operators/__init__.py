"""One pure DataFrame -> DataFrame function per query of the reference."""
