"""The analyses end to end: classification, clustering, search, and their parameter sweeps."""
