"""Documents with the cases every operator must handle, and brute-force helpers."""

from __future__ import annotations

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, start long, line long, score double, spans string"
SPACE = re.compile("[ \t\n\x0b\x0c\r]+")
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def words(text: str | None) -> list[str]:
    return [w for w in SPACE.split(text or "") if w]


def odd_texts(seed: int = 0) -> list[tuple[int | None, str | None]]:
    """Nulls, empty and long texts, ties, repeated rows, near copies, periodic and non-Latin texts."""
    rnd = random.Random(seed)
    vocabulary = ["".join(rnd.choice("abcdeéß") for _ in range(rnd.randint(1, 7))) for _ in range(300)]
    speak = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    passage, base, lined = speak(60), speak(120), "\n".join(speak(12) for _ in range(6))
    texts = [
        None, "", " \n\t ", "one", "a" * 900, "ab " * 300, speak(4000), base, base, base + " tail", "x " + base[:-3],
        speak(40) + " " + passage + " " + speak(30), passage, speak(20) + " " + passage, "Ünïcode ÉÉ 中文 текст İ <|endoftext|> x",
        lined, lined.replace("a", "b", 1), lined + "\n" + lined, "1234 5678 !!!", " \u0085odd", speak(34), speak(35), speak(36),
    ]
    rows = list(enumerate(texts))
    return [*rows, rows[7], (5000, passage), (None, base), (None, None), (-3, "minus id " + speak(3))]


def frame(spark, rows):
    """With extra columns, some of them named like columns that operators make."""
    data = [(i, t, "en", "s", len(t or ""), 1, 2, 0.5, "x") for i, t in rows]
    return spark.createDataFrame(data, SCHEMA)
