"""Small tables with the odd rows that every operator must take, and plain versions of what is tested."""

import hashlib
import random
import re

LONG = " ".join(f"lang{i % 977}" for i in range(60_000))
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SPACE = r"[^\x20\x09-\x0D]+"


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def prose(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(2, 7))) for _ in range(n))


def odd_rows():
    """Nulls, empty and very long texts, ties, repeated rows, null ids and sources."""
    base = prose(1, 120)
    rows = [
        (1, base, "en", "a", 1), (2, base, "en", "a", 1), (2, base, "en", "a", 1), (3, base + " tail end", "en", "b", 1), (4, None, "en", "b", None), (5, "", None, None, 0), (6, " \n\t ", "en", "c", 3),
        (7, LONG, "en", "c", len(LONG)), (8, "one two", "en", None, 7), (None, "orphan text of a few words here", "en", "a", 5), (9, "Ünï " * 90, "de", "b", 9), (10, "x" * 700, "en", "b", 700), (11, prose(2, 300), "fr", "c", 2),
        (12, prose(3, 50) + " " + prose(2, 300) + " " + prose(4, 50), "fr", "a", 2),
    ]
    return rows


def docs(spark, rows=None, extra=False):
    df = spark.createDataFrame(odd_rows() if rows is None else rows, SCHEMA)
    if extra:
        from pyspark.sql import functions as F

        names = ["key", "shard", "slot", "size", "target", "n", "label", "node", "band", "score", "held_out", "word", "kind", "a", "b", "hit", "items", "mark", "bands", "digest", "src", "taken", "part", "need"]
        df = df.withColumns({n: F.lit("clash") for n in names})
    return df


def sha(b):
    return hashlib.sha256(b).hexdigest()
