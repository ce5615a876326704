"""Rarity analytics on Spark: ordinal labels 1 (most common) to 5 (rarest) over large item sets."""
