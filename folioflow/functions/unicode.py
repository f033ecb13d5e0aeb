"""The few scalar functions that no built-in expresses, as Arrow-batched UDFs."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType

from folioflow.functions.text import title_words


@F.pandas_udf(StringType())
def nfkc(s: pd.Series) -> pd.Series:
    """Compatibility composition; ASCII texts pass through untouched."""
    return s.map(lambda t: t if t is None or t.isascii() else unicodedata.normalize("NFKC", t))


@F.pandas_udf(StringType())
def normalise(s: pd.Series) -> pd.Series:
    """Composed, case-folded, with single spaces: for questions of occurrence."""
    return s.map(lambda t: " ".join(unicodedata.normalize("NFKC", t or "").split()).casefold())


@F.pandas_udf(BooleanType())
def appears_in(fact: pd.Series, text: pd.Series) -> pd.Series:
    """Whether a phrase occurs whole, whatever its case and wrapping; an empty phrase does not."""

    def one(f: str | None, t: str | None) -> bool:
        f, t = (" ".join(unicodedata.normalize("NFKC", x or "").split()).casefold() for x in (f, t))
        return bool(f) and re.search(rf"(?<![a-z0-9]){re.escape(f)}(?![a-z0-9])", t) is not None

    return pd.Series([one(f, t) for f, t in zip(fact, text)])


@F.pandas_udf(StringType())
def slug(s: pd.Series) -> pd.Series:
    """ASCII letters and digits of a text, runs of others as one hyphen, 60 characters at most."""

    def one(t: str | None) -> str:
        bare = unicodedata.normalize("NFKD", t or "").encode("ascii", "ignore").decode().lower()
        return re.sub(r"[^a-z0-9]+", "-", bare).strip("-")[:60].strip("-")

    return s.map(one)


#: Letters of a word from which on a slip is allowed, and letters to one slip.
LONG_WORD, LETTERS_A_SLIP = 5, 5


def title_similarity(x: Column | str, y: Column | str) -> Column:
    """Share of two titles' words that pair up; 0 of two titles without words. Equal words pair first; each of
    the rest, in order, with the first word left over that differs from it by one slip (an edit) in five
    letters at most, both being long. Columns only."""
    a, b = (title_words(F.col(c) if isinstance(c, str) else c) for c in (x, y))
    slip = lambda v, w: (F.least(F.length(v), F.length(w)) >= LONG_WORD) & (F.levenshtein(v, w) * LETTERS_A_SLIP <= F.greatest(F.length(v), F.length(w)))
    left = F.aggregate(F.array_except(a, b), F.array_except(b, a), lambda free, w: F.array_remove(free, F.coalesce(F.get(F.filter(free, lambda v: slip(v, w)), F.lit(0)), F.lit(""))))
    paired = F.size(b) - F.size(left)
    return F.coalesce(F.try_divide(paired.cast("double"), (F.size(a) + F.size(b) - paired).cast("double")), F.lit(0.0))


@F.pandas_udf(StringType())
def repaired_location(s: pd.Series) -> pd.Series:
    """A redirect target whose file name holds raw ampersands: those inside ``filename=`` escaped."""

    def one(t: str | None) -> str | None:
        at = -1 if t is None else t.find("filename=")
        if at < 0:
            return t
        head, tail = t[: at + 9], t[at + 9 :]
        end = re.search(r"\.(?:pdf|docx?|html?)(?=&|$)|&(?=[A-Za-z_]+=)", tail, re.I)
        cut = len(tail) if end is None else end.end() if tail[end.start()] == "." else end.start()
        return head + tail[:cut].replace("&", "%26") + tail[cut:]

    return s.map(one)


@F.pandas_udf(StringType())
def decoded(body: pd.Series, charset: pd.Series) -> pd.Series:
    """Bytes as text: by the declared charset, else UTF-8, else Windows-1252."""

    def one(b: bytes | None, c: str | None) -> str | None:
        if b is None:
            return None
        for name in (c, "utf-8"):
            try:
                return bytes(b).decode(name)
            except (LookupError, UnicodeDecodeError, TypeError):
                continue
        return bytes(b).decode("cp1252", "replace")

    return pd.Series([one(b, c) for b, c in zip(body, charset)])
