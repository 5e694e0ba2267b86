"""Writers of prepared, compiled and geometry tables."""
