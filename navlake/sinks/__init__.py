"""Writers of the lake's tables."""
