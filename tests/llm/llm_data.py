"""Rows that several tests share."""

import random


def words(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 8))) for _ in range(n))


def clashing(df):
    """Add columns whose names operators use inside."""
    from pyspark.sql import functions as F

    names = ["row", "id", "hash", "gone", "lines", "size", "mark", "bits", "root", "score", "features", "times",
             "mix_copies", "lines_removed", "text_hash", "label", "k0", "words", "hits", "component_id", "late",
             "kind", "place", "shard", "spans", "base", "payload", "record_id", "offset"]
    return df.withColumns({n: F.lit("x") for n in names})
