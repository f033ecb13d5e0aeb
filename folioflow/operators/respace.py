"""Words that were run together: splits at case, digits and known words, and nothing else."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GLUED, UNKNOWN, AROUND_DIGITS, PIECES, COVER, LONGEST = 8, 4, 3, 2, 0.4, 60
_CASE = re.compile(r"(?<=[a-z])(?=[A-Z][a-z])")
_DIGIT = re.compile(rf"(?<=[A-Za-z]{{{AROUND_DIGITS}}})(?=[0-9])|(?<=[0-9])(?=[A-Za-z]{{{AROUND_DIGITS}}})")


def cover(word: str, lexicon: frozenset[str]) -> list[str] | None:
    """The fewest lexicon words that make a word up, the longer first; none if it can't be."""
    n = len(word)
    best: list[tuple[int, list[str]] | None] = [None] * (n + 1)
    best[n] = (0, [])
    for i in range(n - 1, -1, -1):
        for j in range(n, i + 1, -1):
            if best[j] is not None and word[i:j].lower() in lexicon and (best[i] is None or best[j][0] + 1 < best[i][0]):
                best[i] = (best[j][0] + 1, [word[i:j], *best[j][1]])
    return best[0][1] if best[0] else None


def respaced_word(token: str, lexicon: frozenset[str]) -> str:
    """A token with spaces where words meet. Known words, and tokens that no rule takes apart into known
    pieces, stay as they are; no letter is ever changed."""
    parts = [p for c in _CASE.split(token) for p in _DIGIT.split(c)] if len(token) <= LONGEST else [token]
    known = sum(len(p) for p in parts if p.lower() in lexicon)
    sound = all(len(p) > 2 or p.isdigit() or p.lower() in lexicon for p in parts)
    if len(parts) >= PIECES and sound and not token.isupper() and known >= COVER * len(token):
        return " ".join(respaced_word(p, lexicon) for p in parts)
    m = re.fullmatch(r"([^A-Za-z]*)([A-Za-z]+)([^A-Za-z]*)", token)
    if not m or not GLUED <= len(m[2]) <= LONGEST or m[2].lower() in lexicon:
        return token
    pieces = cover(m[2], lexicon)
    if pieces is None or len(pieces) < PIECES or any(len(p) < 2 for p in pieces):
        return token
    return m[1] + " ".join(pieces) + m[3]


def respaced(df: DataFrame, words: DataFrame, key: str, text: str = "text", most: int = 1_000_000) -> DataFrame:
    """(key, text, changed): texts with run-together words parted by a lexicon of ``most`` words at the
    outside, whose size is checked before it is broadcast. A null text stays null."""
    if words.count() > most:
        raise ValueError(f"the lexicon has more than {most} words")
    lexicon = df.sparkSession.sparkContext.broadcast(frozenset(r[0] for r in words.select("word").collect()))
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[str, str] = {}
        for b in batches:
            out, changed = [], []
            for t in b.column(1).to_pylist():
                n = 0
                if t is not None:
                    parts = re.split(r"(\s+)", t)
                    for i in range(0, len(parts), 2):
                        w = parts[i]
                        if len(w) >= GLUED:
                            if w not in memo:
                                memo[w] = respaced_word(w, lexicon.value)
                            n += memo[w] != w
                            parts[i] = memo[w]
                    t = "".join(parts)
                    if len(memo) > 300_000:
                        memo.clear()
                out.append(t)
                changed.append(n)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string()), pa.array(changed, pa.int32())], ["key", "text", "changed"])

    return df.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, f"key {kind}, text string, changed int").withColumnRenamed("key", key)
