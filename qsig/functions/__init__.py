"""Column helpers: seeded md5 draws (hashing.py) and vector math on arrays (vectors.py)."""
