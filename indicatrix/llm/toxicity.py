"""Toxicity of texts, with obfuscated spellings restored first.

A noisy channel restores words: a letter may have been written as a look-alike, repeated, or set apart by separators. The
lattice of a suspicious stretch of text holds, per written sign, the letters it may stand for, and per run of one letter one
or two letters; Viterbi decoding finds the path of least channel cost plus language-model cost. The language model is a
letter-trigram model counted over all documents; its table has 27^3 entries whatever the input.

The score is a noisy-or over words and word stems (4 to 6 letters), as written and as restored. The evidence of a stem is the
lower Wilson bound of its share of toxic documents among the labelled rows that hold it, taken from a sample of bounded size.
"""

from __future__ import annotations

import re
import zlib
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicatrix.llm.words import buffers, chunks
from indicatrix.session import materialise

# Signs and the letters they may stand for.
LOOK_ALIKES = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "*": "aeiou",
}
SIGNS = "".join(re.escape(s) for s in LOOK_ALIKES)
LETTER = r"[^\W\d_]"
APART = " .-_*"
# Stretches worth decoding: four or more single letters set apart; words with look-alikes before or between letters, with
# three or more of one letter, or with three doubled letters in a row. HINT finds a place inside a word, STRETCH the word.
SPACED = re.compile(rf"(?<![^\W_])(?:{LETTER}|[{SIGNS}])(?:[ .\-_*]{{1,2}}(?:{LETTER}|[{SIGNS}])){{3,}}(?![^\W_])")
HINT = re.compile(rf"{LETTER}[{SIGNS}]+{LETTER}|(?<![^\W_])[013457@$!|€]+{LETTER}|({LETTER})\1\1|(?:({LETTER})\2){{3}}")
STRETCH = re.compile(rf"(?:{LETTER}|[{SIGNS}])+")
SIGN_COST, REPEAT_COST, LETTERS = 1.5, 0.7, 27
WORDS = re.compile(rf"{LETTER}+")
STEMS = (4, 5, 6)
GAP = np.array([32], np.uint8)


def letter_counts(docs: DataFrame) -> np.ndarray:
    """Counts of letter trigrams over all texts; everything but a to z is one boundary sign."""

    def run(batches):
        table = np.zeros(256, np.int64)
        table[97:123] = table[65:91] = np.arange(1, 27)
        total = np.zeros(LETTERS**3, np.int64)
        for batch in batches:
            data, offsets = buffers(batch.column(0))
            for _, _, part, _ in chunks(data, offsets):
                x = table[np.concatenate([GAP, part, GAP])]
                total += np.bincount(x[:-2] * LETTERS**2 + x[1:-1] * LETTERS + x[2:], minlength=LETTERS**3)
        seen = np.flatnonzero(total)
        yield pa.record_batch([pa.array(seen.astype(np.int32)), pa.array(total[seen])], ["gram", "n"])

    rows = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    counts = np.zeros(LETTERS**3)
    for row in rows.collect():
        counts[row["gram"]] = row["n"]
    return counts


def trigram_costs(counts: np.ndarray) -> list[list[list[float]]]:
    """Minus log probability of a letter after two others."""
    table = counts.reshape(LETTERS, LETTERS, LETTERS) + 0.5
    return (-np.log(table / table.sum(axis=2, keepdims=True))).tolist()


def options(sign: str) -> list[tuple[str, float]]:
    """Letters that a sign may stand for, with channel costs."""
    if sign in LOOK_ALIKES:
        return [(letter, SIGN_COST) for letter in LOOK_ALIKES[sign]]
    return [(sign, 0.0)]


def suspicious(text: str) -> set[tuple[str, bool]]:
    """Stretches to decode, and whether their letters are set apart."""
    out = {(m.group(), True) for m in SPACED.finditer(text)}
    end = 0
    for hint in HINT.finditer(text):
        i = hint.start()
        if i >= end:
            while i > end and (text[i - 1] in LOOK_ALIKES or text[i - 1].isalpha()):
                i -= 1
            stretch = STRETCH.match(text, i)
            end = stretch.end()
            out.add((stretch.group(), False))
    return out


def lattice(stretch: str, apart: bool) -> list[list[tuple[str, float]]]:
    """Per run of one written sign, the letter strings it may stand for and their channel costs."""
    signs = [c for c in stretch if c not in APART] if apart else list(stretch)
    out: list[list[tuple[str, float]]] = []
    i = 0
    while i < len(signs):
        j = i
        while j < len(signs) and signs[j] == signs[i]:
            j += 1
        n, column = j - i, []
        for letter, cost in options(signs[i]):
            column.append((letter, cost + REPEAT_COST * (n > 1)))
            if n > 1:
                column.append((letter * 2, 2 * cost + REPEAT_COST * (n > 2)))
        out.append(column)
        i = j
    return out


def viterbi(columns: list[list[tuple[str, float]]], costs: list[list[list[float]]]) -> str:
    """The cheapest path; the state is the last two letters."""
    code = lambda c: ord(c) - 96 if "a" <= c <= "z" else 0
    best: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
    for column in columns:
        after: dict[tuple[int, int], tuple[float, tuple | None]] = {}
        for (a, b), (cost, path) in best.items():
            for letters, channel in column:
                p, q, total = a, b, cost + channel
                for c in letters:
                    x = code(c)
                    total += costs[p][q][x]
                    p, q = q, x
                if (p, q) not in after or total < after[p, q][0]:
                    after[p, q] = (total, (path, letters))
        best = after
    _, path = min((cost + costs[a][b][0], path) for (a, b), (cost, path) in best.items())  # type: ignore[type-var]
    out = []
    while path:
        out.append(path[1])
        path = path[0]
    return "".join(reversed(out))


def decoder(costs):
    @lru_cache(maxsize=50_000)
    def restore(stretch: str, apart: bool) -> str:
        return viterbi(lattice(stretch, apart), costs)

    return restore


def words_of(text: str, restore) -> set[str]:
    """Distinct words of the whole text, as written and as restored."""
    text = text.lower()
    words = set(WORDS.findall(text))
    for stretch, apart in suspicious(text):
        words.update(WORDS.findall(restore(stretch, apart)))
    return words


def stems(words: set[str]) -> set[str]:
    """The words, marked by =, and their stems."""
    out = {"=" + w for w in words}
    for n in STEMS:
        out |= {w[:n] for w in words if len(w) >= n}
    return out


def least_shingle(text: str) -> int:
    """The least hash of the text's three-word shingles, which near copies mostly share and other texts do not."""
    words = text.lower().encode().split()
    return min((zlib.crc32(b" ".join(words[i : i + 3])) for i in range(max(1, len(words) - 2))), default=0)


def evidence(docs: DataFrame, labelled: DataFrame, costs, least: float = 0.5, z: float = 3.0) -> dict[str, float]:
    """Stems and the lower Wilson bounds of their toxic shares, where those reach ``least``.

    ``labelled`` holds doc_id and toxic of a bounded sample, and is broadcast; counting is done by Spark. Copies and near
    copies of a text are one witness: rows count once per least hash of their three-word shingles.
    """

    def run(batches):
        restore = decoder(costs)
        for batch in batches:
            toxic = batch.column(1).to_pylist()
            texts = [t or "" for t in batch.column(0).to_pylist()]
            found = [stems(words_of(t, restore)) for t in texts]
            witness = [least_shingle(t) for t in texts]
            columns = [
                pa.array([x for f in found for x in f], pa.string()),
                pa.array([w for f, w in zip(found, witness) for _ in f], pa.int64()),
                pa.array([t for f, t in zip(found, toxic) for _ in f], pa.int32()),
            ]
            yield pa.record_batch(columns, ["stem", "witness", "toxic"])

    sample = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(labelled), "doc_id").select("text", F.col("toxic").cast("int"))
    witnesses = sample.mapInArrow(run, "stem string, witness long, toxic int").groupBy("stem", "witness").agg(F.max("toxic").alias("toxic"))
    counts = witnesses.groupBy("stem").agg(F.sum("toxic").alias("bad"), F.count("*").alias("n"))
    share, n = F.col("bad") / F.col("n"), F.col("n")
    bound = (share + z * z / (2 * n) - z * F.sqrt(share * (1 - share) / n + z * z / (4 * n * n))) / (1 + z * z / n)
    found = counts.select("stem", bound.alias("weight"), "bad").where(F.col("weight") >= least)
    # Every kept stem has at least z^2 toxic witnesses among the rows of the sample: a small table.
    return distilled({r["stem"]: (r["weight"], r["bad"]) for r in found.collect()})


def distilled(found: dict[str, tuple[float, int]]) -> dict[str, float]:
    """Weights without stems that one whole word explains, and with that word's spelling without doubled letters.

    A stem whose witnesses nearly all hold one evident word says nothing about other words. Decoding may drop a doubled letter.
    """
    words = {s[1:]: f for s, f in found.items() if s[0] == "="}
    explained: dict[str, int] = {}
    for word, (_, bad) in words.items():
        for n in STEMS:
            explained[word[:n]] = max(bad, explained.get(word[:n], 0))
    weights = {s: weight for s, (weight, bad) in found.items() if s[0] == "=" or explained.get(s, 0) < 0.9 * bad}
    for word, (weight, _) in words.items():
        weights.setdefault("=" + re.sub(r"(.)\1+", r"\1", word), weight)
    return weights


class Model:
    """What scoring needs: letter costs, evidence, and the score of a text without evidence."""

    def __init__(self, costs, weights: dict[str, float], prior: float):
        self.costs, self.weights, self.prior = costs, weights, prior


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = 20_000) -> Model:
    """Learns from at most about ``sample_rows`` labelled rows, chosen by a hash of doc_id; held-out rows are left out.

    Letter statistics come from all documents. Labels that are null, or of no document, teach nothing.
    """
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where(
        F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))
    )
    usable = materialise(usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic")), "usable-labels")
    n, bad = usable.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    share = min(1.0, sample_rows / max(n, 1))
    sample = usable.where(F.pmod(F.xxhash64("doc_id", F.lit("toxicity")), F.lit(1_000_003)) < int(share * 1_000_003) + 1)
    costs = trigram_costs(letter_counts(docs))
    weights = evidence(docs, sample, costs) if n else {}
    return Model(costs, weights, min(0.4, 0.25 * bad / n) if n else 0.0)


def with_score(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """Adds a score, 0 to 1, from the whole text alone; null and empty texts have the score of no evidence."""
    sent = docs.sparkSession.sparkContext.broadcast((model.costs, model.weights, model.prior))

    def run(texts: pd.Series) -> pd.Series:
        costs, weights, prior = sent.value
        restore, known = decoder(costs), weights.keys()
        out = []
        for text in texts:
            miss = 1.0 - prior
            for stem in stems(words_of(text or "", restore)) & known:
                miss *= 1.0 - weights[stem]
            out.append(1.0 - miss)
        return pd.Series(out, dtype="float64")

    return docs.withColumn(name, F.pandas_udf(run, "double")(F.col("text").cast("string")))


def toxicity(docs: DataFrame, labels: DataFrame, sample_rows: int = 20_000) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    scored = with_score(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), fit(docs, labels, sample_rows))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
