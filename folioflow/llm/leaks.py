"""Problem 8: evaluation passages in training text, by a prefix-filtered set join with exact verification."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.llm.visual import Table, _form_of, code_points, compose, moved
from folioflow.session import cut

#: A leak holds NEED of WINDOW successive words of the item.
WINDOW, NEED = 30, 25
#: Places at which words may stand between the item's words in the document, for the prefix bound: each breaks one
#: shingle. A passage with more of them is found only by what the bound leaves over.
STRAY = 5
#: Shingles that a prefix has beyond those a leak can break: so many of them are found in any leak.
BEYOND = 5
#: Shingles are pairs of successive words, written without the space; of an item of one word that word.
SHINGLE = 2
#: An item may cover at most this multiple of its length in the document.
STRETCH = 1.6
#: Stripes of 2 ** BITS characters of the difference between place in text and place in item; three in a row
#: hold what lost and stray words shift.
BITS = 6
#: Characters by which a word may stand off its place in the item.
SLACK = 192
#: Bits a shingle of the filter that tasks look hashes up in.
SPARSE = 16
#: Characters at a shingle's beginning that are looked up first, where it has as many.
STEM = 8
#: Places of prefix shingles that a task holds, of some 32 bytes each with their share of the items' words; items
#: with more go in slices of that size.
MOST_PLACES = 4_000_000
#: How a text, an item and a stripe make one number: bits of item and stripe, and what keeps stripes positive.
ITEM_BITS, STRIPE_BITS, AHEAD = 22, 24, 1 << 20
#: Characters whose hashes are taken together.
TOGETHER = 250_000


def _fold_of(ch: str) -> str:
    """Visual form, folded to lower case; marks that compose were composed before."""
    return "".join(c for c in unicodedata.normalize("NFC", ch.casefold()) if unicodedata.category(c)[0] in "LNM")


@lru_cache(1)
def tables() -> tuple[Table, Table]:
    return Table(_form_of), Table(_fold_of)


def folded(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all texts the letters, digits and marks alone, folded, as one code-point array; the offsets of each
    text in it; and where something else stood before a character, so that a word may begin there."""
    look, fold = tables()
    cps, at = code_points(texts)
    out, src = look.apply(cps)
    cps, at = compose(out, moved(at, src))
    out, src = fold.apply(cps)
    if src is None:
        src = np.arange(len(cps))
    at_out = np.searchsorted(src, at)
    start = np.zeros(len(out) + 1, bool)
    start[0] = True
    start[1:-1] = np.diff(src) > 1
    start[at_out] = True
    return out, at_out, start


def streams(texts: pa.Array) -> tuple[list[str], list[np.ndarray]]:
    """``folded`` text by text: the characters as a string, and where a word may begin."""
    out, at, start = folded(texts)
    whole = out.astype("<u4").tobytes().decode("utf-32-le")
    return [whole[a:b] for a, b in zip(at.tolist(), at[1:].tolist())], [start[a : b + 1] for a, b in zip(at.tolist(), at[1:].tolist())]


def words_of(texts: pa.Array) -> list[list[str]]:
    out = []
    for body, begin in zip(*streams(texts)):
        cuts = np.flatnonzero(begin).tolist()
        out.append([body[a:b] for a, b in zip(cuts, cuts[1:]) if b > a])
    return out


_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_TURNS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


@lru_cache(4)
def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base))
    out[0] = 1
    return np.multiply.accumulate(out)


def _values(cps: np.ndarray) -> np.ndarray:
    x = (cps.astype(np.uint64) + np.uint64(1)) * _TURNS[1]
    return (x ^ (x >> np.uint64(31))) * _TURNS[2]


def sums(cps: np.ndarray) -> np.ndarray:
    """Running sums of the characters' values times a power of their place: the hash of any stretch is the
    difference of two, brought back to place 0. All modulo 2 ** 64."""
    size = max(TOGETHER, 1 << int(len(cps)).bit_length())
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum(_values(cps) * _powers(int(_BASE), size)[: len(cps)], dtype=np.uint64)])


def hashes(total: np.ndarray, n: int) -> np.ndarray:
    """Of the running sums the hashes of all stretches of ``n`` characters."""
    size = max(TOGETHER, 1 << int(len(total) - 1).bit_length())
    return (total[n:] - total[:-n]) * _powers(int(_INVERSE), size)[: len(total) - n]


def hash_of(text: str) -> int:
    return int(sums(np.frombuffer(text.encode("utf-32-le"), np.uint32))[-1].view(np.int64))


class Bitmap:
    """Which hashes are among those given, but for chance hits: four lookups in SPARSE bits a hash."""

    def __init__(self, known: np.ndarray) -> None:
        self.shift = np.uint64(64 - max(10, int(SPARSE * max(len(known), 1)).bit_length()))
        self.bits = np.zeros(1 << int(64 - self.shift - np.uint64(3)), np.uint8)
        for turn in _TURNS:
            at = (known * turn) >> self.shift
            np.bitwise_or.at(self.bits, at >> np.uint64(3), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))

    def hits(self, h: np.ndarray) -> np.ndarray:
        """Places of the hashes that pass."""
        place = None
        for turn in _TURNS:
            at = (h * turn) >> self.shift
            ok = np.flatnonzero(self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & np.uint8(1))
            place = ok if place is None else place[ok]
            h = h[ok]
        return place


class Index:
    """The places of the prefix shingles, as arrays: all that a task holds of the items.

    A bitmap tells most hashes apart; those that pass are looked up among the sorted hashes, each with the items
    and places that have it.
    """

    def __init__(self, h: np.ndarray, stem: np.ndarray, item: np.ndarray, off: np.ndarray, size: np.ndarray, ids: pa.Array, words: pa.Array, least: np.ndarray) -> None:
        order = np.argsort(h, kind="stable")
        h, self.item, self.off = h[order], item[order].astype(np.int32), off[order].astype(np.int32)
        self.known, first = np.unique(h, return_index=True)
        self.at = np.append(first, len(h))
        self.ids, self.words, self.least, self.lengths = ids, words, least, np.unique(size).tolist()
        self.whole, self.stems = Bitmap(self.known), Bitmap(np.unique(stem[size >= STEM]))

    def places(self, total: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(length, places, hashes) of the stretches that may be shingles. Those of STEM characters or more are
        only looked for where the first STEM of one stand."""
        n = len(total) - 1
        begins = self.stems.hits(hashes(total, STEM)) if n >= STEM and self.lengths and self.lengths[-1] >= STEM else np.zeros(0, np.int64)
        power = _powers(int(_INVERSE), max(TOGETHER, 1 << n.bit_length()))
        for size in self.lengths:
            if size < STEM and size <= n:
                h = hashes(total, size)
                p = self.whole.hits(h)
                yield size, p, h[p]
            elif size >= STEM:
                p = begins[: np.searchsorted(begins, n - size, "right")]
                h = (total[p + size] - total[p]) * power[p]
                ok = self.whole.hits(h)
                yield size, p[ok], h[ok]

    def candidates(self, cps: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, item, stripe) from which on three stripes of a text have the hits that a leak of the item must
        have. ``at`` holds the offsets of the texts in ``cps``."""
        none = np.zeros(0, np.int64)
        if not len(self.known) or not len(cps):
            return none, none, none
        total = sums(cps)
        keys = []
        for n, p, h in self.places(total):
            k = np.minimum(np.searchsorted(self.known, h), len(self.known) - 1)
            row = np.searchsorted(at, p, "right") - 1
            ok = (self.known[k] == h) & (p + n <= at[row + 1])  # not over the end of a text
            p, k, row = p[ok], k[ok], row[ok]
            many = self.at[k + 1] - self.at[k]
            each = np.repeat(np.arange(len(p)), many)
            entry = np.arange(len(each)) - np.repeat(np.cumsum(many) - many, many) + self.at[k][each]
            stripe = ((p - at[row])[each] - self.off[entry] >> BITS) + AHEAD
            keys.append((row[each] << ITEM_BITS + STRIPE_BITS) | (self.item[entry].astype(np.int64) << STRIPE_BITS) | stripe)
        key, n = np.unique(np.concatenate(keys) if keys else none, return_counts=True)
        held = n.copy()
        for d in (1, 2):  # the next keys, if they are of the next two stripes
            near = key[d:] - key[:-d] <= 2
            held[:-d] += np.where(near, n[d:], 0)
        item = (key >> STRIPE_BITS) & (1 << ITEM_BITS) - 1
        ok = held >= self.least[item] if len(key) else np.zeros(0, bool)
        return (key >> ITEM_BITS + STRIPE_BITS)[ok], item[ok], (key & (1 << STRIPE_BITS) - 1)[ok] - AHEAD


def prefixes(items: DataFrame) -> DataFrame:
    """(h, stem, item_id, off, least, size): the hash of each shingle, and of its first STEM characters, that a leak of the item can't avoid, its place in the
    item, and how many of them stand in any leak. ``items`` holds (item_id, words).

    Shingles are ordered by rarity: the fewer items hold one, the rarer, ties by length and text. A window
    of n words has n - 1 shingles; a lost word breaks two, a stray one breaks one, so of the window's
    rarest ``prefix`` shingles at least ``least`` stand in any leak. Only prefix shingles are looked up.
    """
    pair = lambda k: F.concat(F.get("words", k), F.coalesce(F.get("words", k + 1), F.lit("")))
    each = items.select("item_id", F.posexplode(F.transform(F.sequence(F.lit(0), F.greatest(F.size("words") - SHINGLE, F.lit(0))), pair)).alias("k", "shingle"))
    held = each.groupBy("shingle").agg(F.countDistinct("item_id").alias("held"))
    rated = each.join(held, "shingle").groupBy("item_id").agg(F.array_sort(F.collect_list(F.struct("k", "held"))).alias("rated"))
    rows = items.join(rated, "item_id").select("item_id", "words", F.col("rated.held").alias("held"))
    kind = items.schema["item_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for key, words, many in zip(*(c.to_pylist() for c in b.columns)):
                n = min(WINDOW, len(words))
                broken = SHINGLE * (n - -(-NEED * n // WINDOW)) + STRAY
                prefix = max(1, min(n - 1, broken + BEYOND))
                least = max(1, prefix - broken)
                off = np.concatenate([[0], np.cumsum([len(x) for x in words])]).tolist()
                text = [x + y for x, y in zip(words, words[1:])] or words
                chosen = set()
                for w in range(len(words) - n + 1):
                    chosen.update(sorted(range(w, w + max(n - 1, 1)), key=lambda k: (many[k], -len(text[k]), text[k], k))[:prefix])
                out += [(hash_of(text[k]), hash_of(text[k][:STEM]), key, off[k], least, len(text[k])) for k in sorted(chosen)]
            types = [pa.int64(), pa.int64(), b.schema.types[0], pa.int32(), pa.int32(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)] if out else [pa.array([], t) for t in types], ["h", "stem", "item_id", "off", "least", "size"])

    return rows.mapInArrow(run, f"h bigint, stem bigint, item_id {kind}, off int, least int, size int")


def holds(words: list[str], body: str, begin: np.ndarray, at: int) -> bool:
    """Whether some window of the item has its needed words in order near where it would stand if the
    item began at ``at``: the longest chain of (word, place) with both rising and no overlap. Words of up
    to three letters must stand free. Each word is looked for within SLACK of its own place only."""
    n = min(WINDOW, len(words))
    need = -(-NEED * n // WINDOW)
    off = [0]
    for x in words:
        off.append(off[-1] + len(x))
    find = body.find
    seen, run = [], [0]
    for w, o in zip(words, off):
        lo = at + o - SLACK
        p = find(w, lo if lo > 0 else 0, at + o + SLACK + len(w)) if at + o + SLACK > 0 else -1
        seen.append(p)
        run.append(run[-1] + (p >= 0))
    starts = [w for w in range(len(words) - n + 1) if run[w + n] - run[w] >= need]
    if not starts:
        return False
    occ: list[tuple[int, int, int]] = []
    for j, p in enumerate(seen):
        size, hi = len(words[j]), at + off[j] + SLACK + len(words[j])
        while p >= 0:
            if size > 3 or (begin[p] and begin[p + size]):
                occ.append((p, j, p + size))
            p = find(words[j], p + 1, hi)
    occ.sort()
    reach = int(STRETCH * off[-1]) + 1
    for w in starts:
        own = [o for o in occ if w <= o[1] < w + n]
        if len({j for _, j, _ in own}) >= need and chain(own, reach) >= need:
            return True
    return False


def chain(occ: list[tuple[int, int, int]], reach: int) -> int:
    best = 0
    top: list[tuple[int, int]] = []
    for i, (p, j, e) in enumerate(occ):
        most, first = 0, p
        for k in range(i):
            q, jj, ee = occ[k]
            if jj < j and ee <= p and e - top[k][1] <= reach and top[k][0] > most:
                most, first = top[k]
        top.append((most + 1, first))
        best = max(best, most + 1)
    return best


def _found(shared, kind: str, item_kind: str):  # noqa: ANN001, ANN202
    """(doc_id, item_id) of the leaks. Hashes are taken of all stretches that are as long as some shingle and
    counted, many texts at a time; where enough stand in a row, the text is checked."""

    def taken(ids: pa.Array, texts: pa.Array) -> pa.RecordBatch:
        known: Index = shared.value
        cps, at, start = folded(texts)
        tried: dict[tuple[int, int], list[int]] = {}
        for row, item, stripe in zip(*(x.tolist() for x in known.candidates(cps, at))):
            tried.setdefault((row, item), []).append(stripe)
        rows, items = [], []
        last, body, begin = -1, "", start
        for (row, item), stripes in sorted(tried.items()):
            if row != last:
                a, b = int(at[row]), int(at[row + 1])
                last, body, begin = row, cps[a:b].astype("<u4").tobytes().decode("utf-32-le"), start[a : b + 1]
            words = known.words[item].as_py().split(" ")
            if any(holds(words, body, begin, ((x + 1) << BITS) + (1 << BITS - 1)) for x in stripes):
                rows.append(row)
                items.append(item)
        return pa.RecordBatch.from_arrays([ids.take(pa.array(rows, pa.int64())), known.ids.take(pa.array(items, pa.int64()))], ["doc_id", "item_id"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size = np.cumsum(pc.utf8_length(b.column(1)).to_numpy(zero_copy_only=False))
            cuts = [0, *(np.flatnonzero(np.diff(size // TOGETHER)) + 1).tolist(), b.num_rows] if b.num_rows else []
            for x, y in zip(cuts, cuts[1:]):
                if y > x:
                    yield taken(b.column(0).slice(x, y - x), b.column(1).slice(x, y - x))

    return run, f"doc_id {kind}, item_id {item_kind}"


def leaks(documents: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id): documents whose text holds at least NEED of some WINDOW successive words of the
    item, in order and close together.

    A join with the items' prefix shingles on the broadcast side, whose size is checked: tasks hold the places of
    the shingles and the items' words as arrays (``Index``), MOST_PLACES at most; items with more are taken in
    slices, each of which reads the documents again. Length and positional bound: place in the text less place in
    the item is the same for all shingles of a leak, but for what lost and stray words shift; hits are counted by
    item and stripe of that difference. Where three stripes in a row have the hits that a leak must have, the text
    is checked exactly. Nothing is shuffled but the pairs found. An item of fewer than WINDOW words needs the
    same share of all its words. Null ids and texts hold nothing; repeated items and documents give one row a pair.
    """
    spark = documents.sparkSession
    kind, item_kind = (t.schema[c].dataType.simpleString() for t, c in ((documents, "doc_id"), (items, "item_id")))

    def apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(words_of(b.column(1)), pa.list_(pa.string()))], ["item_id", "words"])

    pool = items.where("item_id is not null and text is not null").groupBy("item_id").agg(F.min("text").alias("text"))
    pool = cut(pool.mapInArrow(apart, f"item_id {item_kind}, words array<string>").where(F.size("words") > 0))
    prefix = cut(prefixes(pool))
    docs = documents.where("doc_id is not null and text is not null").select("doc_id", "text")
    slices = max(1, -(-prefix.count() // MOST_PLACES))
    out = None
    for k in range(slices):
        own = F.pmod(F.xxhash64("item_id"), F.lit(slices)) == k
        words = pool.where(own).select("item_id", F.array_join("words", " ").alias("words")).toPandas().sort_values("item_id", ignore_index=True)
        part = prefix.where(own).toPandas()
        code = words["item_id"].searchsorted(part["item_id"]).astype(np.int64) if len(part) else np.zeros(0, np.int64)
        least = np.ones(len(words), np.int64)
        least[code] = part["least"].to_numpy()
        h, stem = (part[c].to_numpy(np.int64).view(np.uint64) for c in ("h", "stem"))
        index = Index(h, stem, code, part["off"].to_numpy(np.int64), part["size"].to_numpy(), pa.array(words["item_id"]), pa.array(words["words"], pa.large_string()), least)
        run, ddl = _found(spark.sparkContext.broadcast(index), kind, item_kind)
        one = docs.mapInArrow(run, ddl)
        out = one if out is None else out.unionByName(one)
    return out.distinct()
