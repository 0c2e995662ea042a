"""Table operators and ML stages."""
