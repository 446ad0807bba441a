"""Dataset builds, guards and exports: what ties transforms to paths."""
