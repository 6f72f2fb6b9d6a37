"""Small documents with what operators must cope with."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, tag string, bucket int, score string, _id int, fp string"
SYLLABLES = {"en": "th an er on ing ea st wh", "de": "sch ei ung ber zu ü ach pf", "es": "ción ado os ñ ll que mente ra"}


def prose(rng: random.Random, lang: str, words: int) -> str:
    parts = SYLLABLES[lang].split()
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(words))


def texts(seed: int = 3) -> list[tuple[str | None, str | None]]:
    """(text, lang): copies, near copies, shared passages, null, empty, blank, long and symbol-only texts."""
    rng = random.Random(seed)
    shared = prose(rng, "en", 60)
    out: list[tuple[str | None, str | None]] = []
    for k in range(60):
        lang = ("en", "de", "es")[k % 3]
        text = prose(rng, lang, rng.randint(20, 120))
        if k % 5 == 0:
            text = f"{text}\n{shared}  {prose(rng, lang, 5)}"
        out.append((text, lang if k % 7 else None))
    out += [out[1], out[1], (out[2][0].replace(" ", "  ", 3), "es"), (out[4][0] + " one more", "de")]
    out += [(None, "en"), ("", "en"), (" \n\t", None), ("### 123 !!!", "en"), ("x", None), ("A" * 5000, None), ("ab " * 4000, "en")]
    out.append((prose(rng, "en", 40000), "en"))
    return out


def frame(spark: SparkSession, rows: list[tuple[int | None, str | None, str | None]]) -> DataFrame:
    data = [(i, t, lang, f"src{(i or 0) % 3}", len(t) if t else None, "x", None, 1, "s", 2, "f") for i, t, lang in rows]
    return spark.createDataFrame(data, SCHEMA)


def documents(spark: SparkSession) -> DataFrame:
    rows = [(7 * k % 211, t, lang) for k, (t, lang) in enumerate(texts())]
    first = rows[3]
    return frame(spark, [*rows, first, (None, rows[5][1], "es"), (None, None, None)]).repartition(3)
