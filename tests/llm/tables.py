"""Tables that the tests share."""

from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, n_chars long, cls string, row string, rest string, page int"


def frame(spark, rows):
    """Rows of (doc_id, text), with columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, "en", len(t or ""), "c", "r", "s", 1) for i, t in rows], SCHEMA)


def words(seed, n, many=50):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(many)}" for _ in range(n))
