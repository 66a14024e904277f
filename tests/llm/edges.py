"""Documents at the edges of every contract, and the fixtures that several tests share."""

import random

#: Columns that clash with names the operators use inside.
CLASHING = ("row", "score", "fingerprint", "words", "shape", "key", "token", "rid", "k", "size", "shard", "label", "passages", "ids", "n", "doc")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"`{c}` string" for c in CLASHING)
PROSE = {
    "en": "the river runs under the old bridge and the people of the town watch the water from their windows every evening",
    "de": "der fluss zieht unter der alten brücke hindurch und die leute der stadt schauen jeden abend aus ihren fenstern",
    "fr": "la rivière passe sous le vieux pont et les gens de la ville regardent l'eau depuis leurs fenêtres chaque soir",
}


def prose(seed: int, lang: str = "en", n: int = 60) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(PROSE[lang].split()) for _ in range(n))


def rows() -> list[tuple]:
    """Null ids, nulls in any column, empty, wordless and very long texts, ties and repeated rows."""
    texts = [
        (1, prose(1), "en"), (2, prose(2, "de"), "de"), (3, prose(3, "fr"), "fr"), (4, prose(1), "en"), (4, prose(1), "en"),
        (5, None, "en"), (6, "", None), (7, " \t\n ", "de"), (8, "!!! ... ###", "fr"), (9, "word", "en"), (10, "Two Words", None),
        (None, prose(4), "en"), (None, None, None), (11, prose(5, "en", 15_000), "en"), (12, "x" * 300_000, None), (13, "a " * 5000, "en"),
        (14, "日本語のテキスト 🙂 ÀÉ ß", None), (15, "12345 678", "en"), (16, prose(2, "de"), None),
    ]
    return [(i, t, lang, None if i == 3 else f"src{(i or 0) % 2}", None, *[f"{c}!" for c in CLASHING]) for i, t, lang in texts]


def documents(spark, extra: list[tuple] = ()):
    """The edge rows and more of ``(doc_id, text, lang)``."""
    more = [(*row, "src9", None, *[None for _ in CLASHING]) for row in extra]
    return spark.createDataFrame([*rows(), *more], SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def as_set(df) -> list:
    return sorted(map(repr, df.collect()))
