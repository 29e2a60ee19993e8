"""Tables with the odd cases that every operator has to bear."""

from pyspark.sql import functions as F

CLASH = (
    "row", "fingerprint", "rank", "length", "words", "h", "site", "score", "task", "places", "start", "body", "id_key", "size",
    "doc", "pos", "host", "rule", "kept", "first", "gone", "root", "least", "rare",
)
LONG = " ".join(f"wort{i % 977} line{i}" for i in range(60_000))
TEXTS = [
    (1, "The quick brown fox. Apache License here\nsame line\nsame line", "en", "s1"),
    (2, None, "en", "s1"),
    (2, None, "en", "s1"),
    (3, "", None, None),
    (4, " \n\t\n ", "de", "s2"),
    (None, "A text without an id, mail me: a.b@c.example.org", "en", "s2"),
    (None, None, None, None),
    (5, LONG, "en", "s3"),
    (6, "tie tie tie", "fr", "s3"),
    (7, "tie tie tie", "fr", "s3"),
    (7, "tie tie tie", "fr", "s3"),
    (8, "\x1c\x85\u3000 Ünïcødé 中文 emoji 😀 İK Σς \u0000 +1 (961) 555-6946", "es", "s4"),
]
SCHEMA = "doc_id bigint, text string, lang string, source string"


def odd(spark, rows=TEXTS):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("n_chars", F.length("text").cast("bigint"))
    return df.withColumns({c: F.lit(f"x{c}") for c in CLASH})


def empty(spark):
    return odd(spark).where("false")
