"""Documents with nulls, empty and very long texts, ties and repeats, and columns whose
names the operators use themselves."""

import random

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(words: int, seed: int) -> str:
    rng = random.Random(seed)
    made = ["".join(rng.choice(["the", "an", "or", "ti", "on", "re", "st"]) for _ in range(rng.randint(1, 4)))
            for _ in range(words)]
    return " ".join(w + ("\n" if i % 17 == 16 else "") for i, w in enumerate(made))


def rows():
    long = prose(30_000, 5)
    base = prose(120, 6)
    out = [
        (1, None, None, None, None), (2, "", "en", "a", 0), (3, "   \n\t \n", "en", "a", 7), (4, "word", "xx", "a", 4),
        (5, base, "en", "a", len(base)), (6, base, "en", "b", len(base)), (7, base + " and", "en", None, len(base) + 4),
        (8, long, "en", "a", len(long)), (9, "日本語 テスト 🤖 é́ ▁ x", "ja", "", 20), (None, prose(40, 7), None, "b", None),
        (None, "", "de", "b", None), (10, "<s> </s> <|endoftext|> <0x0A> [UNK]", "en", "b", 30),
        (11, "same line\nsame line\nsame line", "en", "b", 29), (12, prose(40, 8), "de", None, 10),
        (12, prose(40, 8), "de", None, 10), (12, prose(41, 9), "fr", None, 10), (-5, "a\0b c", "en", "z", 5),
    ]
    return out + [(20 + i, f"{base} {i}" if i % 2 else f"short {i}", "en", "c", 1) for i in range(30)]


CLASHES = ("size", "taken", "target", "shard", "slot", "region", "node", "component", "class", "block", "bucket", "pass",
           "position", "score", "label", "lines", "n_lines", "n_dropped", "key", "kind", "start", "ids", "n_tokens", "digest")


def frame(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


def crowded(spark):
    """The same with clashing columns."""
    return frame(spark).withColumns({c: F.lit("mine") for c in CLASHES})


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
