"""Small corpora and plain word helpers."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return WORD.findall(text or "")


def ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def corpus(seed=1, n=60, vocabulary=60, longest=80):
    """Rows with copies, near copies, empty, null and long texts, odd white space and letters beyond ASCII."""
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdeéßñ") for _ in range(rng.randint(1, 7))) for _ in range(vocabulary)]
    texts = []
    for i in range(n):
        kind = rng.random()
        if texts and kind < 0.15:
            text = rng.choice(texts)
        elif texts and kind < 0.35:
            ws = words(rng.choice(texts))
            if ws:
                ws[rng.randrange(len(ws))] = "Changed"
            text = " ".join(ws)
        else:
            ws = [rng.choice(vocab) for _ in range(rng.randint(0, longest))]
            text = rng.choice(["", " ", "\n"]).join([""]) + rng.choice([" ", "  ", "\n", "\t "]).join(w.title() if rng.random() < 0.2 else w for w in ws)
        texts.append(text)
    texts += ["", None, " \n", "one", "Two words", "\x0b\x0c x y  z", " ".join(vocab * 30)]
    return [(i, t, "en", f"s{i % 3}" if i % 7 else None, len(t or "")) for i, t in enumerate(texts)]


def frame(spark, rows, extra=True):
    """Documents with columns whose names an operator might use for itself."""
    df = spark.createDataFrame(rows, DOCS).repartition(3)
    if extra:
        from pyspark.sql import functions as F

        for name in ("score", "size", "fp", "n", "word", "spans", "matches", "taken", "target", "windows", "anchor"):
            df = df.withColumn(name, F.lit("x"))
    return df
