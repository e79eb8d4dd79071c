"""Writers. Every write replaces what the target held before."""
