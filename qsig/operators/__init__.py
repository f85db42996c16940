"""Operators, one module per family: terms, pairs, samples, features, similarity, scoring,
kmeans, mlkmeans, augment; ordering holds the distributed per-group ordinals."""
