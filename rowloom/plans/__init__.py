from rowloom.plans.skew import SkewOptions, heavy_keys, key_counts, skew_join

__all__ = ["SkewOptions", "heavy_keys", "key_counts", "skew_join"]
