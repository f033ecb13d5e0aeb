"""Problem 4: noise in scanned text - furniture, broken words, misread characters - and its repair."""

from __future__ import annotations

import math
import re
import unicodedata
import zlib
from collections import Counter
from collections.abc import Collection, Iterator
from itertools import accumulate

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioflow.llm.furniture import BODY, CONFUSIONS, FOOTNOTE, FURNITURE, Roles, series
from folioflow.llm.lines import doc_chunks, groups, heads_of
from folioflow.session import cut, stage

#: Words of the lexicon at most, which bounds what is broadcast; a lexicon word is among so many most frequent
#: ones, whatever the size of the corpus, and has this count.
LEXICON_WORDS, WORD_COUNT = 1_000_000, 4
#: Costs in nats: a confusion, an inserted word break, a removed one, a removed line break, a line break
#: with a hyphen removed, a word that is not in the lexicon and each of its letters.
CONFUSED, SPLIT, MERGED, RUN_ON, HYPHEN, STRANGE, LETTER = 4.0, 5.0, 5.0, 7.0, 0.5, 9.0, 1.6
#: Confusions in one word at most, letters up to which the second is tried, and letters of a lexicon word.
MOST_CONFUSED, TWICE, LONGEST = 2, 18, 28
#: Letters of a strange piece from which on its parts, too, may hold a confusion.
RUN_TOGETHER = 10
#: Pieces that are decoded together at most; a longer run of strange ones is decoded in such stretches.
TOGETHER = 12
#: A line with three strange words or more, and more than this share, is not prose unless decoding explains
#: this share of them; a word of fewer letters than TELLING is explained by chance and doesn't count for that.
STRANGE_SHARE, EXPLAINED, TELLING = 0.34, 0.5, 4
MARKS = "-‐\xad¬"

#: What stands between words: white space and these marks. A soft hyphen inside a word is no mark.
_BETWEEN = "!\"#$%&()*+,./:;<=>?@[\\]^_`{}~'“”‘’«»—–•·।॥…-‐¬§¶©¤€�"
_ASCII = bytes(32 if chr(i) in _BETWEEN else i for i in range(128)) + bytes(range(128, 256))
_OTHER = [c for c in _BETWEEN if ord(c) > 127]
_ORDINAL = re.compile(r"[0-9]+(?:st|nd|rd|th|[a-z])\Z")
_READ = [(r, t) for t, r in CONFUSIONS]
_REMOVED = {" ": MERGED, "\n": RUN_ON}


def _spaced(text: str) -> str:
    """Lower case, with a space for each mark; line breaks stay. ASCII marks go as bytes, others one by one,
    so a long text costs a few passes in C."""
    t = text.lower().encode("utf-8", "surrogatepass").translate(_ASCII).decode("utf-8", "surrogatepass")
    if not t.isascii():
        for c in _OTHER:
            if c in t:
                t = t.replace(c, " ")
        if "\xad" in t:
            t = t.replace("\xad", "")
    return t


def words_of(text: str) -> list[str]:
    return _spaced(text).split()


def line_words(texts: list[str]) -> list[list[str]]:
    """The words of each line, taken apart together."""
    lines = _spaced("\n".join(texts)).split("\n")
    return [x.split() for x in lines] if len(lines) == len(texts) else [words_of(t) for t in texts]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: Counter[str] = Counter()
    for b in batches:
        if b.num_rows:
            whole = pa.ListArray.from_arrays(pa.array([0, b.num_rows], pa.int32()), b.column(0).fill_null(""))
            seen.update(words_of(pc.binary_join(whole, "\n")[0].as_py()))
        if len(seen) > 400_000:
            yield from _give(seen)
            seen = Counter()
    yield from _give(seen)


def _give(seen: Counter) -> Iterator[pa.RecordBatch]:
    if seen:
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])


def lexicon(lines: DataFrame, most: int = LEXICON_WORDS) -> tuple[dict[str, int], int]:
    """Counts of the ``most`` most frequent words of all lines, as far as they occur WORD_COUNT times, and the
    number of all words.

    Counted in the scan's own tasks first, so that the shuffle carries one row a word and task. Where the cut
    falls is told from the number of words by size of their count, in steps of a twelfth of a doubling, of which
    there are at most 768; words of the step that the cut falls in are left out.
    """
    counts = lines.select("text").mapInArrow(_count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    counts = cut(counts)
    step = F.floor(F.log2("n") * 12).cast("int")
    steps = sorted(((r["step"], r["words"], r["n"]) for r in counts.groupBy(step.alias("step")).agg(F.count("*").alias("words"), F.sum("n").alias("n")).collect()), reverse=True)
    total, held, least = sum(n for _, _, n in steps), 0, 0
    for k, words, _ in steps:
        held += words
        if held > most:
            least = k + 1
            break
    kept = counts.where((F.col("n") >= WORD_COUNT) & (step >= least)).toPandas()
    return dict(zip(kept["word"], kept["n"])), total


class Weights(dict):
    """A weight for each character such that both sides of every confusion weigh the same. A text that is a
    lexicon word but for confusions, however many, therefore weighs what that word does; others are told by
    that at once."""

    def __init__(self) -> None:
        own = {c: zlib.crc32(c.encode()) + (1 << 33) for c in "etasgzy"}  # one weight a class of single letters
        e, t, a, s, g, z, y = own.values()
        of = {"e": e, "t": t, "a": a, "s": s, "g": g, "z": z, "y": y, "i": 1, "r": 1, "h": 2, "u": 2, "n": 2, "m": 3, "d": e + 1, "k": e + 1, "w": 2 * y, "b": 2, "c": e, "l": 1, "f": t, "o": a, "q": g, "v": y}
        super().__init__(of)
        for true, read in CONFUSIONS:
            if len(true) == len(read) == 1 and read not in of:
                self[read] = of[true]
        for true, read in CONFUSIONS:
            if self.of(true) != self.of(read):
                raise ValueError(f"{true} and {read} don't weigh the same")

    def __missing__(self, c: str) -> int:
        w = self[c] = (zlib.crc32(c.encode("utf-8", "surrogatepass")) << 20) + ord(c) + (1 << 54)
        return w

    def of(self, text: str) -> int:
        return sum(map(self.__getitem__, text))


class Decoder:
    """Joint segmentation of a short run of pieces: which words they are, where words were split, merged or
    broken over lines, and which characters were misread."""

    def __init__(self, counts: dict[str, int], total: int) -> None:
        self.total = max(total, 2)
        self.cost = {w: -math.log(n / self.total) for w, n in counts.items() if not w.isdigit()}
        self.least = min(self.cost.values(), default=0.0)
        self.weight = Weights()
        self.heavy = set(map(self.weight.of, self.cost))
        self.seen: dict[tuple, tuple] = {}
        self.fine: dict[str, bool] = {}
        self.read: dict[tuple[str, int], tuple[float, str, tuple[int, ...]]] = {}

    def known(self, word: str) -> bool:
        return word in self.cost

    def variants(self, s: str, most: int = MOST_CONFUSED) -> tuple[float, str, tuple[int, ...]]:
        """The cheapest lexicon word that ``s`` can be read for, with the places of the confusions. Two are
        tried where no single one explains it, and ``most`` allows it."""
        hit = self.read.get((s, most))
        if hit is None:
            if len(self.read) > 400_000:
                self.read.clear()
            hit = self.read[s, most] = self._variants(s, most)
        return hit

    def _variants(self, s: str, most: int) -> tuple[float, str, tuple[int, ...]]:
        best = (self.cost.get(s, math.inf), s, ())
        if best[0] <= self.least + CONFUSED or self.weight.of(s) not in self.heavy:
            return best
        layer = [(s, (), 0)]
        for k in range(1, most + 1):
            following = []
            for text, places, least in layer:
                for read, true in _READ:
                    p = text.find(read, least)
                    while p >= 0:
                        t = text[:p] + true + text[p + len(read) :]
                        at = (*places, p)
                        c = self.cost.get(t)
                        if c is not None and c + k * CONFUSED < best[0]:
                            best = (c + k * CONFUSED, t, at)
                        if k < most and len(s) <= TWICE:
                            following.append((t, at, p + len(true)))
                        p = text.find(read, p + 1)
            if best[2]:
                break
            layer = following
        return best

    def decode(self, pieces: tuple[str, ...], breaks: tuple[str, ...]) -> tuple[list[str], list[bool], list[bool]]:
        """Viterbi over the pieces' letters. ``breaks`` holds what stood between two pieces: " ", "\\n" or a
        hyphen at a line end. Gives the words, for each piece whether it has a misread letter, and for each
        break whether it was taken out.

        One lattice: an arc is a word from one place in the letters to another, with a charge for each break it
        runs over and for a beginning or an end within a piece. A word over whole pieces may hold confusions,
        whatever breaks it runs over, and so may a part of a piece of RUN_TOGETHER letters or more that would
        else stay strange. A whole piece of any length may be a strange word.
        """
        hit = self.seen.get((pieces, breaks))
        if hit is not None:
            return hit
        out = self._path(pieces, breaks, False)
        if out[3]:
            out = self._path(pieces, breaks, True)
        if len(self.seen) > 100_000:
            self.seen.clear()
        self.seen[pieces, breaks] = out[:3]
        return out[:3]

    def _path(self, pieces: tuple[str, ...], breaks: tuple[str, ...], parts: bool) -> tuple[list[str], list[bool], list[bool], bool]:
        """The best path of ``decode``, without or with confusions in parts of pieces, and whether a piece of
        RUN_TOGETHER letters or more stayed strange on it."""
        s = "".join(pieces)
        cut = [0]
        for p in pieces:
            cut.append(cut[-1] + len(p))
        kind = dict(zip(cut[1:-1], breaks))
        ends = {a: b for a, b in zip(cut, cut[1:])}
        n, inf = len(s), math.inf
        before = [0, *accumulate(map(self.weight.__getitem__, s))]
        heavy = self.heavy
        best: list[tuple] = [(inf,)] * (n + 1)
        best[0] = (0.0, 0, "", (), False)
        for i in range(n):
            if best[i][0] == inf:
                continue
            at_cut = i in ends
            opened = 0.0 if at_cut else SPLIT
            over = 0.0
            for j in range(i + 1, min(n, i + LONGEST) + 1):
                if j - 1 > i and j - 1 in kind:
                    over += _REMOVED.get(kind[j - 1], HYPHEN)
                word = s[i:j]
                arc, wrong = self.cost.get(word, inf), ()
                if at_cut and (j in kind or j == n):
                    if before[j] - before[i] in heavy and (over == 0.0 or arc == inf):
                        arc, word, wrong = self.variants(word, MOST_CONFUSED if over == 0.0 else 1)
                elif j - i < 3 and not parts and not (j - i == 2 and (at_cut or j in kind or j == n)):
                    continue
                elif parts and arc == inf and over == 0.0 and j - i > 3 and before[j] - before[i] in heavy:
                    arc, word, wrong = self.variants(word, 1)
                if arc < inf and (c := best[i][0] + arc + over + opened) < best[j][0]:
                    best[j] = (c, i, word, tuple(i + w for w in wrong), False)
            if at_cut:
                j = ends[i]
                c = best[i][0] + STRANGE + LETTER * (j - i)
                if c < best[j][0]:
                    best[j] = (c, i, s[i:j], (), True)
        words, wrong, kept, strange, j = [], [], set(), False, n
        while j > 0:
            _, i, w, x, odd = best[j]
            words.append(w)
            wrong += x
            kept.add(i)
            strange |= odd and j - i >= RUN_TOGETHER
            j = i
        bad = [any(a <= w < b for w in wrong) for a, b in zip(cut, cut[1:])]
        return words[::-1], bad, [p not in kept for p in cut[1:-1]], strange

    def is_fine(self, token: str) -> bool:
        """Whether one token, alone, is read as it stands."""
        ok = self.fine.get(token)
        if ok is None:
            if len(self.fine) > 400_000:
                self.fine.clear()
            ok = self.fine[token] = self._fine(token)
        return ok

    def _fine(self, t: str) -> bool:
        if t.isdigit() or len(t) < 2 or not any(c.isalnum() for c in t):
            return True
        c = self.cost.get(t, math.inf)
        if c < 2 * CONFUSED:
            return True
        return c < math.inf and self.variants(t)[1] == t

    def number(self, t: str) -> bool:
        """A number of which a digit was read as a letter."""
        return bool(re.fullmatch(r"[0-9loisb]{2,8}", t)) and any(c.isdigit() for c in t) and not t.isdigit() and not _ORDINAL.match(t)


class Page:
    """A chunk's lines with what was found in each."""

    def __init__(self, document_id: str, page: list[int], index: list[int], texts: list[str], ahead: list[bool], roles: Roles, dec: Decoder, heads: Collection[str] = ()) -> None:
        self.page, self.index, self.texts, self.ahead = page, index, texts, ahead
        self.role = roles.of(document_id, page, texts, heads)
        self.hyphen = [False] * len(texts)
        self.misread = [False] * len(texts)
        self.tokens: list[list[str]] = line_words(texts)
        for kind in (BODY, FOOTNOTE):
            self._scan([i for i, r in enumerate(self.role) if r == kind], dec)

    def _scan(self, order: list[int], dec: Decoder) -> None:
        """Decode the running text as one stream of words without lines. Words that are read as they stand are
        fixed; the others, and words on either side of a line end with a hyphen, are decoded with their
        neighbours, over line ends, those next to each other together."""
        fine, known = dec.fine, dec.is_fine
        stream: list[str] = []
        breaks: list[str] = []
        owner: list[int] = []
        marked: list[int] = []
        ends: list[tuple[int, int]] = []
        odd_of: dict[int, int] = {}
        for i in order:
            toks = self.tokens[i]
            if not toks:
                continue
            text = self.texts[i].rstrip()
            at = len(stream)
            if ends and ends[-1][0] == at - 1:
                marked.append(at)  # what a broken word goes on with
            odd = [at + k for k, t in enumerate(toks) if not (fine[t] if t in fine else known(t))]
            odd_of[i] = len(odd)
            marked += [k for k in odd if not marked or k > marked[-1]]
            stream += toks
            owner += [i] * len(toks)
            breaks += [" "] * (len(toks) - 1) + ["\n"]
            if len(text) > 1 and text[-1] in MARKS and (text[-2].isalpha() or unicodedata.category(text[-2])[0] == "M"):
                last = len(stream) - 1
                breaks[last] = text[-1]
                ends.append((last, i))
                if not marked or marked[-1] != last:
                    marked.append(last)
        bad: set[int] = set()
        removed: set[int] = set()
        n, a = len(stream), 0
        while a < len(marked):
            b = a + 1
            while b < len(marked) and marked[b] - marked[b - 1] <= 1 and marked[b] - marked[a] < TOGETHER - 2:
                b += 1
            lo, hi = max(0, marked[a] - 1), min(n, marked[b - 1] + 2)
            if breaks[marked[b - 1]] not in " \n" and hi < n and b - a > 1 and hi - lo <= TOGETHER:
                hi += breaks[hi - 1] == " "
            _, wrong, out = dec.decode(tuple(stream[lo:hi]), tuple(breaks[lo : hi - 1]))
            for k in marked[a:b]:
                if wrong[k - lo] or dec.number(stream[k]):
                    bad.add(k)
                if k + 1 < hi and out[k - lo]:
                    removed.add(k)
            a = b
        joined: set[int] = set()
        for k, i in ends:
            if k + 1 == n or not stream[k + 1][0].isalpha():
                self.hyphen[i] = not dec.known(stream[k])
            elif k in removed or not dec.known(stream[k + 1]):
                self.hyphen[i] = True
                joined |= {k, k + 1}
                for x in (k, k + 1):
                    if x in bad:
                        self.misread[owner[x]] = True
        read: dict[int, list[int]] = {}
        for k in bad - joined:
            read.setdefault(owner[k], []).append(k)
        for i, found in read.items():
            if odd_of[i] > 2:
                toks = self.tokens[i]
                strange = [t for t in toks if t not in dec.cost and not t.isdigit()]
                if len(strange) > STRANGE_SHARE * len(toks) and sum(len(stream[k]) >= TELLING for k in found) < EXPLAINED * len(strange):
                    continue
            self.misread[i] = True

    def noise(self) -> Iterator[tuple[int, str]]:
        for i, at in enumerate(self.index):
            if self.ahead[i]:
                continue
            if self.role[i] == FURNITURE:
                yield at, "furniture"
            else:
                if self.hyphen[i]:
                    yield at, "hyphen"
                if self.misread[i]:
                    yield at, "misread"

    def paragraphs(self, dec: Decoder) -> Iterator[tuple[str, int, int, str, bool, bool]]:
        """(kind, first stream index, last, text, runs on from the chunk before, runs on in the next) of the
        running text and the notes, repaired, furniture left out. Lines of the chunks before and after only lend
        their words to what is broken at either end."""
        for kind, name in ((BODY, "text"), (FOOTNOTE, "note")):
            order = [i for i, r in enumerate(self.role) if r == kind and self.texts[i].strip()]
            lines = repaired([self.texts[i] for i in order], [self.hyphen[i] for i in order], [self.misread[i] for i in order], dec)
            for a, b in paragraph_spans([self.texts[i] for i in order], [self.hyphen[i] for i in order]):
                own = [k for k in range(a, b) if not self.ahead[order[k]]]
                text = _KEPT.sub("-", " ".join(lines[k] for k in own if lines[k]))
                if own and text:
                    yield name, self.index[order[own[0]]], self.index[order[own[-1]]], text, own[0] > a, own[-1] < b - 1


_DIGITS = str.maketrans("lIi|oOsSbB", "1111005588")
_SAME = str.maketrans({c: " " for c in "!\"#$%&()*+,./:;<=>?@[\\]^_`{}~'“”‘’«»—–•·।॥…-‐¬§¶©¤€�\xad"})
_OPENING = re.compile(r"\s*(?:[\[(]?(?:[0-9]{1,4}[A-Z]{0,2}|[a-z]{1,2}|[ivxlc]{1,6})[\])]|[0-9]{1,4}[A-Z]{0,2}\.|[•\-–*]\s|(?:PART|CHAPTER|SCHEDULE|Provided|Explanation)\b)")
#: A compound that was broken at its own hyphen.
_KEPT = re.compile(r"(?<=\w)[-‐] (?=[a-z])")
_CLOSED = re.compile(r"[.!?।:;][\"'”’)\]]*\s*\Z")


def like_case(word: str, model: str) -> str:
    return word.upper() if len(model) > 1 and model.isupper() else word[:1].upper() + word[1:] if model[:1].isupper() else word


def repaired(texts: list[str], hyphens: list[bool], misread: list[bool], dec: Decoder) -> list[str]:
    """The lines with misread words as they were, words that were split or run together put right, and
    broken words whole on the line they begin on. Punctuation and case stay."""
    out, drop = [], 0
    for n, text in enumerate(texts):
        raw = text.rstrip()
        own = raw[:-1] if hyphens[n] else raw
        flat = own.lower().translate(_SAME)
        if len(flat) != len(own):
            out.append(own[drop:].strip())
            drop = 0
            continue
        pieces = [m.span() for m in re.finditer(r"\S+", flat) if m.start() >= drop]
        text, at = [], drop
        drop, skip = 0, False
        for k, (a, b) in enumerate(pieces):
            if skip:
                skip = False
                continue
            token, new, end = flat[a:b], own[a:b], b
            if hyphens[n] and k == len(pieces) - 1 and n + 1 < len(texts):
                rest = re.match(r"\s*(\S+)", texts[n + 1].lower().translate(_SAME))
                if rest:
                    words, _, joined = dec.decode((token, rest[1]), ("-",))
                    if joined[0] or not dec.known(token):
                        whole = "".join(words) if joined[0] else token + rest[1]
                        new, drop = like_case(whole, own[a:b]), rest.end()
            elif not dec.is_fine(token):
                if dec.number(token):
                    new = own[a:b].translate(_DIGITS)
                else:
                    c = pieces[k + 1] if k + 1 < len(pieces) else None
                    if c and own[b : c[0]].isspace() and not (hyphens[n] and k + 2 == len(pieces)):
                        words, _, joined = dec.decode((token, flat[c[0] : c[1]]), (" ",))
                        if joined[0] and len(words) == 1:
                            new, end, skip = like_case(words[0], own[a:b]), c[1], True
                    if not skip:
                        words, bad, _ = dec.decode((token,), ())
                        if bad[0] or len(words) > 1:
                            new = like_case(" ".join(words), own[a:b])
            text.append(own[at:a] + new)
            at = end
        text.append(own[at:])
        out.append(re.sub(r"\s+", " ", "".join(text)).strip())
    return out


#: Lines of a paragraph from which on each costs OVER.
LONG, OVER = 40, 0.1


def paragraph_spans(texts: list[str], hyphens: list[bool]) -> list[tuple[int, int]]:
    """Paragraphs as spans of lines, by dynamic programming: the division whose beginnings look most like
    beginnings, with a charge for each paragraph and for each line over LONG, of which there may be any number. A line begins one if it
    opens with a number or label, if the line before is closed, short or both; not after a broken word, and
    hardly with a small letter."""
    n = len(texts)
    if not n:
        return []
    size = sorted(len(t.rstrip()) for t in texts)
    full = size[int(0.8 * (n - 1))] or 1
    gain = [0.0] * n
    for i in range(1, n):
        before, line = texts[i - 1].rstrip(), texts[i].lstrip()
        g = 3.2 if _OPENING.match(line) else 0.0
        closed = _CLOSED.search(before) is not None
        g += 1.0 if closed else -2.0
        g += 1.0 if len(before) < 0.75 * full else -0.5
        if line[:1].islower():
            g -= 2.5
        gain[i] = -50.0 if hyphens[i - 1] else g
    best, back = [0.0] + [-1e18] * n, [0] * (n + 1)
    far, top = 0, -math.inf  # of all beginnings LONG lines or more before: their order stays, so the best one is enough
    for j in range(1, n + 1):
        if j >= LONG and (c := best[j - LONG] + gain[j - LONG] + OVER * (j - LONG)) > top:
            far, top = j - LONG, c
        for i in (*((far,) if j >= LONG else ()), *range(max(0, j - LONG + 1), j)):
            c = best[i] + gain[i] - 0.5 - OVER * max(0, j - i - LONG)
            if c > best[j]:
                best[j], back[j] = c, i
    out, j = [], n
    while j > 0:
        out.append((back[j], j))
        j = back[j]
    return out[::-1]


class Model:
    """What all tasks share: the lexicon, of LEXICON_WORDS words at most."""

    def __init__(self, lines: DataFrame) -> None:
        self.value = lines.sparkSession.sparkContext.broadcast(lexicon(lines))

    def tools(self) -> tuple[Decoder, Roles]:
        return Decoder(*self.value.value), Roles()


def noisy_lines(lines: DataFrame) -> DataFrame:
    """(document_id, stream_index, noise): the lines with furniture, a broken word or a misread one.

    A broken word whose rest stands on the first page of the next chunk is seen from both (``doc_chunks``): its
    line is reported by its own chunk, a misreading in its rest by the next.
    Empty lines carry no noise but furniture, and lines of strange words no misreading unless decoding explains
    half of them. No lines: no rows.
    """
    model = Model(lines)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dec, roles = model.tools()
        for b in batches:
            ids, at, noise = [], [], []
            for heads, (did, page, index, texts, ahead) in zip(heads_of(b), groups(b)):
                for i, kind in Page(did, page, index, texts, ahead, roles, dec, heads).noise():
                    ids.append(did)
                    at.append(i)
                    noise.append(kind)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(at, pa.int32()), pa.array(noise, pa.string())], ["document_id", "stream_index", "noise"])

    return doc_chunks(lines, True, series(lines)).select("document_id", "lines").mapInArrow(run, "document_id string, stream_index int, noise string")


def paragraphs(lines: DataFrame) -> DataFrame:
    """(document_id, chunk, kind, paragraph, first_index, last_index, text): each document as continuous
    paragraphs of repaired text, its notes as paragraphs of kind ``note``, without running heads, feet and
    page numbers. ``paragraph`` counts within the chunk and kind; first_index is the order to read them in. A
    paragraph that runs over the end of a chunk is told there, where both sides are seen, and its parts are put
    together again: at most two rows a chunk and kind take part in that."""
    model = Model(lines)
    names = ["document_id", "chunk", "kind", "paragraph", "first_index", "last_index", "text", "from_before", "on_after"]
    types = [pa.string(), pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.bool_(), pa.bool_()]
    schema = "document_id string, chunk int, kind string, paragraph int, first_index int, last_index int, text string, from_before boolean, on_after boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dec, roles = model.tools()
        for b in batches:
            rows: list[tuple] = []
            for chunk, heads, (did, page, index, texts, ahead) in zip(b.column(2).to_pylist(), heads_of(b), groups(b)):
                seen: Counter[str] = Counter()
                for kind, *rest in Page(did, page, index, texts, ahead, roles, dec, heads).paragraphs(dec):
                    rows.append((did, chunk, kind, seen[kind], *rest))
                    seen[kind] += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)] if rows else [pa.array([], t) for t in types], names)

    rows = stage(doc_chunks(lines, True, series(lines)).select("document_id", "lines", "chunk").mapInArrow(run, schema), "paragraphs")
    open_ = F.col("from_before") | F.col("on_after")
    w = Window.partitionBy("document_id", "kind").orderBy("first_index")
    linked = F.col("from_before") & F.coalesce(F.lag("on_after").over(w) & (F.lag("chunk").over(w) == F.col("chunk") - 1), F.lit(False))
    parts = rows.where(open_).withColumn("fresh", (~linked).cast("int")).withColumn("whole", F.sum("fresh").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("first_index", "text"))), lambda x: x["text"]), " ")
    first = lambda c: F.min_by(c, "first_index").alias(c)
    merged = parts.groupBy("document_id", "kind", "whole").agg(first("chunk"), first("paragraph"), F.min("first_index").alias("first_index"), F.max("last_index").alias("last_index"), F.regexp_replace(text, r"(?<=\\w)[-‐] (?=[a-z])", "-").alias("text"))
    out = names[:7]
    return rows.where(~open_).select(out).unionByName(merged.select(out))


def repaired_labels(labels: DataFrame, lines: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, text): the distinct texts of labelled blocks (notes, heads), each as one repaired stretch. The
    lexicon is that of all lines. A null text stays null."""
    model = Model(lines)
    kept = labels.select(*keys, "text").distinct()
    schema = kept.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dec, _ = model.tools()
        memo: dict[str, str] = {}
        for b in batches:
            out = []
            for t in b.column(b.num_columns - 1).to_pylist():
                if t is not None and t not in memo:
                    if len(memo) > 100_000:
                        memo.clear()
                    texts = t.split("\n")
                    page = Page("", [1] * len(texts), list(range(len(texts))), texts, [False] * len(texts), Roles(), dec)
                    broken = [len(x.rstrip()) > 1 and x.rstrip()[-1] in MARKS and page.hyphen[i] for i, x in enumerate(texts)]
                    memo[t] = " ".join(x for x in repaired(texts, broken, page.misread, dec) if x)
                out.append(None if t is None else memo[t])
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(out, pa.string())], b.schema.names)

    return kept.mapInArrow(run, schema)
