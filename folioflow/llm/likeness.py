"""Problem 5: documents that share most of their text, by sketches compared bit-sliced within LSH buckets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.functions.unicode import title_similarity
from folioflow.llm.lines import doc_chunks, groups
from folioflow.llm.scans import words_of
from folioflow.operators.graph import connected_components, forest
from folioflow.session import cut

#: Words of a shingle, and the share of all shingles of two documents that must occur in both.
SHINGLE, ALIKE = 3, 0.5
#: Minima a document, and how many of them make a band: documents of likeness 0.5 share none of the
#: MINIMA / BAND bands with probability (1 - 0.5 ** BAND) ** (MINIMA / BAND) = 0.0002, of 0.6 with 2e-7.
MINIMA, BAND = 192, 3
#: Bits of two sketches that differ at most, for a pair to be verified: the mean at likeness 0.5 and 4.5
#: deviations; and for a pair to stand in for others of its bucket: as far below the mean.
RADIUS, SURE = 75, 20
#: Members of a bucket that are compared at once; larger buckets go in blocks.
BLOCK = 512
#: Candidate documents up to which their ids are broadcast to filter the lines; beyond, the filter is a join.
BROADCAST_IDS = 400_000
#: Times that a hot bucket is banded again before it goes block by block.
DEPTH = 1
#: Pairs that are compared together.
PAIRS = 500_000
#: Bit planes after which blocks of pairs that are all beyond the radius are abandoned.
ABANDON = 48

_rng = np.random.default_rng(20260923)
#: A permutation of the 32-bit numbers for each minimum: an odd factor and a mask.
_MUL = _rng.integers(0, 1 << 32, MINIMA, dtype=np.uint32) | np.uint32(1)
_MASK = _rng.integers(0, 1 << 32, MINIMA, dtype=np.uint32)
_MIX = np.uint64(0x9E3779B97F4A7C15)


class Shingler:
    def __init__(self) -> None:
        self.memo: dict[str, int] = {}

    def of(self, words: list[str]) -> np.ndarray:
        """Distinct 64-bit hashes of the runs of SHINGLE words."""
        if len(words) < SHINGLE:
            return np.zeros(0, np.uint64)
        memo = self.memo
        if len(memo) > 500_000:
            memo.clear()
        for w in words:
            if w not in memo:
                memo[w] = xxhash.xxh3_64_intdigest(w)
        h = np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
        out = h[: len(h) - SHINGLE + 1].copy()
        for k in range(1, SHINGLE):
            out = (out * _MIX) ^ (out >> np.uint64(29)) ^ h[k : len(h) - SHINGLE + 1 + k]
        return np.unique(out)


def minima(shingles: np.ndarray) -> np.ndarray:
    """MINIMA min-hashes; of an empty set all ones."""
    out = np.full(MINIMA, 0xFFFFFFFF, np.uint32)
    for a in range(0, len(shingles), 8192):
        part = (shingles[a : a + 8192] >> np.uint64(32)).astype(np.uint32)
        np.minimum(out, (part[None, :] * _MUL[:, None] ^ _MASK[:, None]).min(axis=1), out=out)
    return out


def chunk_words(texts: list[str], ahead: list[bool]) -> list[str]:
    """A chunk's words, with the first words of the chunk after it that its last shingles reach into."""
    own = words_of("\n".join(t for t, a in zip(texts, ahead) if not a))
    after = [t for t, a in zip(texts, ahead) if a]
    return own + words_of("\n".join(after))[: SHINGLE - 1] if after else own


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shingler = Shingler()
    held: dict[str, np.ndarray] = {}

    def give() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array([m.tobytes() for m in held.values()], pa.binary())], ["document_id", "minima"])

    for b in batches:
        for did, _, _, texts, ahead in groups(b):
            m = minima(shingler.of(chunk_words(texts, ahead)))
            held[did] = np.minimum(held[did], m) if did in held else m
        if len(held) > 20_000:
            yield give()
            held = {}
    if held:
        yield give()


def sketches(lines: DataFrame) -> DataFrame:
    """(document_id, minima): min-hashes of each document with a shingle at least. Chunks of one document
    are merged in each task first, so it is merged from one row a task at most."""
    parts = doc_chunks(lines).select("document_id", "lines").mapInArrow(_sketch, "document_id string, minima binary")

    @F.pandas_udf("binary")
    def least(many):  # noqa: ANN001, ANN202
        return many.map(lambda x: x[0] if len(x) == 1 else np.minimum.reduce([np.frombuffer(m, np.uint32) for m in x]).tobytes())

    whole = parts.groupBy("document_id").agg(F.collect_list("minima").alias("many"))
    none = np.full(MINIMA, 0xFFFFFFFF, np.uint32).tobytes()
    return whole.select("document_id", least("many").alias("minima")).where(F.col("minima") != F.lit(bytearray(none)))


def band_keys(minima: list[bytes]) -> np.ndarray:
    """The keys of the bands of each set of minima."""
    m = np.frombuffer(b"".join(minima), np.uint32).reshape(-1, MINIMA).astype(np.uint64)
    key = np.zeros((len(m), MINIMA // BAND), np.uint64)
    for k in range(BAND):
        key = (key ^ m[:, k::BAND]) * _MIX
        key ^= key >> np.uint64(31)
    return (key + np.arange(MINIMA // BAND, dtype=np.uint64)) * _MIX


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, doc) of each band of rows (doc, minima) or, of rows (doc, minima, key) in a hot bucket, of each band
    within that bucket; the band that made the bucket makes it again and is left out."""
    for b in batches:
        if not b.num_rows:
            continue
        key = band_keys(b.column(1).to_pylist())
        doc = np.repeat(b.column(0).to_numpy(), MINIMA // BAND)
        if b.num_columns > 2:
            old = b.column(2).to_numpy().view(np.uint64)[:, None]
            fresh = (key != old).reshape(-1)
            key = ((key ^ (old >> np.uint64(29))) + old) * _MIX
            key, doc = key.reshape(-1)[fresh], doc[fresh]
        yield pa.RecordBatch.from_arrays([pa.array(key.reshape(-1).view(np.int64)), pa.array(doc)], ["key", "doc"])


def planes_within(x: np.ndarray, radius: int) -> np.ndarray:
    """Which rows of ``x`` (pairs, bytes of both sketches xored) have ``radius`` bits set at most.

    The rows' bits are stored as planes, 64 pairs to a word. A carry-save adder turns three planes of one
    weight into a sum and a carry, so a counter of a few words counts for 64 pairs at a time. Words of which
    all pairs are beyond the radius are left behind after each ABANDON planes.
    """
    n, bits = len(x), x.shape[1] * 8
    pad = -n % 64
    rows = np.concatenate([x, np.full((pad, x.shape[1]), 255, np.uint8)]) if pad else x
    planes = np.ascontiguousarray(np.packbits(np.unpackbits(rows, axis=1).T, axis=1)).view(np.uint64)
    out = np.zeros(planes.shape[1], np.uint64)
    at = np.arange(planes.shape[1])
    height = bits.bit_length()
    count = [np.zeros(len(at), np.uint64) for _ in range(height)]
    for k in range(0, bits, ABANDON):
        level = [planes[i][at] for i in range(k, min(k + ABANDON, bits))]
        for weight in range(height):
            level.append(count[weight])
            carry = []
            while len(level) > 2:
                a, b, c = level.pop(), level.pop(), level.pop()
                ab = a ^ b
                level.append(ab ^ c)
                carry.append((a & b) | (ab & c))
            if len(level) == 2:
                a, b = level
                carry.append(a & b)
                level = [a ^ b]
            count[weight] = level[0]
            level = carry
            if not carry and weight + 1 < height:
                break
        over, equal = np.zeros(len(at), np.uint64), np.full(len(at), ~np.uint64(0))
        for weight in reversed(range(height)):
            if radius >> weight & 1:
                equal &= count[weight]
            else:
                over |= equal & count[weight]
                equal &= ~count[weight]
        live = ~over != 0
        if k + ABANDON >= bits:
            out[at] = ~over
        elif not live.all():
            at = at[live]
            if not len(at):
                break
            count = [c[live] for c in count]
    return np.unpackbits(out.view(np.uint8))[:n].astype(bool)


def compare(doc: np.ndarray, bits: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a, b): what to verify of the pairs i, j of rows, which lie in one bucket each. Pairs surely alike are
    given as the trees they make; others within the radius if the trees leave them apart."""
    x = bits[i] ^ bits[j]
    near = planes_within(x, RADIUS)
    i, j, x = i[near], j[near], x[near]
    if not len(i):
        return doc[:0], doc[:0]
    sure = planes_within(x, SURE)
    root = np.arange(len(doc))
    if sure.any():
        node, top = forest(i[sure], j[sure])
        root[node] = top
    leaf = np.flatnonzero(root != np.arange(len(doc)))
    apart = ~sure & (root[i] != root[j])
    a, b = np.concatenate([doc[root[leaf]], doc[i[apart]]]), np.concatenate([doc[leaf], doc[j[apart]]])
    return np.minimum(a, b), np.maximum(a, b)


def inner_pairs(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of rows within each group, for the groups' offsets."""
    size = np.diff(at)
    left, right = [], []
    for n in np.unique(size):
        if n > 1:
            i, j = np.triu_indices(n, 1)
            first = at[:-1][size == n][:, None]
            left.append((first + i).ravel())
            right.append((first + j).ravel())
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def _compare_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs within each group; in a group with two sides (block pairs of a large bucket) across them only.
    Groups are taken together until they make PAIRS pairs or so, to share the planes."""
    for batch in batches:
        lists = batch.column(0)
        at = np.asarray(lists.offsets)
        doc = lists.values.field("doc").to_numpy()
        side = lists.values.field("side").to_numpy(zero_copy_only=False)
        bits = np.frombuffer(b"".join(lists.values.field("bits").to_pylist()), np.uint8).reshape(-1, MINIMA // 8)
        begun = np.cumsum(np.diff(at).astype(np.int64) ** 2) // PAIRS
        for k in np.unique(begun):
            some = np.flatnonzero(begun == k)
            i, j = inner_pairs(at[some[0] : some[-1] + 2])
            if side.any():
                owner = np.repeat(np.arange(len(at) - 1), np.diff(at))
                split = np.zeros(len(at) - 1, bool)
                split[owner[side]] = True
                keep = ~split[owner[i]] | (side[i] != side[j])
                i, j = i[keep], j[keep]
            x, y = compare(doc, bits, i, j)
            if len(x):
                pairs = np.unique(np.stack([x, y], axis=1), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])


def candidates(docs: DataFrame) -> DataFrame:
    """(a, b): pairs of document hashes that share a band and lie within the radius, or stand in for such
    pairs. ``docs`` holds (doc, minima, bits), one row for each different set of minima.

    Buckets are counted by partial aggregates. One of BLOCK members at most is one group. A hot one is never a
    group: its members are held against its least document, and are linked to it where they are surely like
    it. If all are, that is all. Else the bucket is banded again: members meet in the bands they share within it,
    of which likeness 0.5 leaves out all with probability 0.0002, in buckets that shrink with each turn, for DEPTH
    turns. What is hot even then goes block by block: those that aren't surely like the least are held against
    all blocks, so that no pair is missed and no group is larger than two blocks.
    """
    rows = docs.select("doc", "minima").mapInArrow(_bands, "key bigint, doc bigint")
    bits = docs.select("doc", "bits")
    tables, links = [], []
    member = lambda side: F.struct("doc", "bits", F.lit(side).alias("side"))
    for turn in range(DEPTH + 1):
        counts = cut(rows.groupBy("key").agg(F.count("*").alias("n"), F.min("doc").alias("first")).where("n > 1"))
        cold = cut(rows.join(counts.where(F.col("n") <= BLOCK).select("key"), "key"))
        tables.append(cold.join(bits, "doc").groupBy("key").agg(F.collect_list(member(False)).alias("members")).select("members"))
        hot = counts.where(F.col("n") > BLOCK)
        if hot.isEmpty():
            break
        first_bits = bits.select(F.col("doc").alias("first"), F.col("bits").alias("first_bits"))
        held = rows.join(hot, "key").join(bits, "doc").join(first_bits, "first")
        held = cut(held.select("key", "n", "first", "doc", distance("bits", "first_bits").alias("off")))
        links.append(held.where((F.col("off") <= SURE) & (F.col("doc") != F.col("first"))).select(F.least("first", "doc").alias("a"), F.greatest("first", "doc").alias("b")))
        open_ = held.join(held.where(F.col("off") > SURE).select("key").distinct(), "key", "left_semi")
        if open_.isEmpty():
            break
        if turn < DEPTH:
            rows = open_.join(docs.select("doc", "minima"), "doc").select("doc", "minima", "key").mapInArrow(_bands, "key bigint, doc bigint")
            continue
        blocks = F.ceil(F.col("n") / BLOCK).cast("bigint")
        each = F.sequence(F.lit(0).cast("bigint"), blocks - 1)
        own = open_.withColumn("block", F.pmod(F.xxhash64("doc", "key"), blocks)).join(bits, "doc")
        far = own.where(F.col("off") > SURE).select("key", "n", "doc", "bits").withColumn("part", F.pmod(F.xxhash64("doc"), blocks))
        parts = far.select("key", "part").distinct()
        left = own.join(parts, "key").select("key", "block", "part", "doc", "bits")
        right = far.select("key", F.explode(each).alias("block"), "part", "doc", "bits")
        both = left.select("key", "block", "part", member(False).alias("m")).unionByName(right.select("key", "block", "part", member(True).alias("m")))
        tables.append(both.groupBy("key", "block", "part").agg(F.collect_list("m").alias("members")).select("members"))
    found = tables[0]
    for t in tables[1:]:
        found = found.unionByName(t)
    out = found.mapInArrow(_compare_blocks, "a bigint, b bigint").where("a <> b")
    for x in links:
        out = out.unionByName(x)
    return out.distinct()


def distance(a: str, b: str):  # noqa: ANN201
    """Bits in which two sketches differ."""

    @F.pandas_udf("int")
    def count(x, y):  # noqa: ANN001, ANN202
        import pandas as pd

        u, v = (np.frombuffer(b"".join(z), np.uint8).reshape(-1, MINIMA // 8) for z in (x, y))
        return pd.Series(np.unpackbits(u ^ v, axis=1).sum(axis=1).astype(np.int32))

    return count(F.col(a), F.col(b))


def _shingle_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shingler = Shingler()
    for b in batches:
        ids, sets = [], []
        for did, _, _, texts, ahead in groups(b):
            ids.append(did)
            sets.append(shingler.of(chunk_words(texts, ahead)).view(np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(sets, pa.list_(pa.int64()))], ["document_id", "shingles"])


def verified(lines: DataFrame, pairs: DataFrame) -> DataFrame:
    """(a, b): the pairs of document ids of which at least half of all distinct shingles occur in both.

    The lines are read again, of the documents in pairs only: their ids are broadcast if they are at most
    BROADCAST_IDS, else the filter is a shuffled semi-join. Documents of one chunk are held against each
    other as arrays; for others the shared shingles are counted by a join on the shingle, in any number of tasks.
    """
    ids = cut(pairs.select(F.col("a").alias("document_id")).unionByName(pairs.select(F.col("b").alias("document_id"))).distinct())
    few = ids.count() <= BROADCAST_IDS
    sets = doc_chunks(lines.join(F.broadcast(ids) if few else ids, "document_id", "left_semi")).select("document_id", "lines").mapInArrow(_shingle_sets, "document_id string, shingles array<bigint>")
    sets = cut(sets)
    chunks = sets.groupBy("document_id").agg(F.count("*").alias("chunks"), F.max(F.size("shingles")).alias("size"))
    single = sets.join(chunks.where("chunks = 1").select("document_id"), "document_id", "left_semi")
    side = lambda n: single.select(F.col("document_id").alias(n), F.col("shingles").alias(f"s{n}"))
    fit = lambda common, size_a, size_b: common * (1 / ALIKE + 1) >= size_a + size_b
    plain = pairs.join(side("a"), "a").join(side("b"), "b")
    out = plain.where(fit(F.size(F.array_intersect("sa", "sb")), F.size("sa"), F.size("sb"))).select("a", "b")
    large = chunks.where("chunks > 1").select("document_id")
    if large.isEmpty():
        return out
    odd = pairs.join(large.select(F.col("document_id").alias("a")), "a", "left_semi").unionByName(pairs.join(large.select(F.col("document_id").alias("b")), "b", "left_semi")).distinct()
    rows = sets.select("document_id", F.explode("shingles").alias("h")).distinct()
    size = rows.groupBy("document_id").agg(F.count("*").alias("size"))
    common = odd.join(rows.select(F.col("document_id").alias("a"), "h"), "a").join(rows.select(F.col("document_id").alias("b"), "h"), ["b", "h"]).groupBy("a", "b").agg(F.count("*").alias("common"))
    sized = common.join(size.select(F.col("document_id").alias("a"), F.col("size").alias("size_a")), "a").join(size.select(F.col("document_id").alias("b"), F.col("size").alias("size_b")), "b")
    return out.unionByName(sized.where(fit(F.col("common"), F.col("size_a"), F.col("size_b"))).select("a", "b"))


def like_groups(lines: DataFrame) -> DataFrame:
    """(document_id, group_id): documents that are alike, directly or through others, with the least id of
    their group. Documents like no other have no row; nor have those of fewer than three words.

    Documents with the same minima are one in the search, so copies, were they a third of all rows, meet as
    one; each is then verified against the first of them.
    """
    @F.pandas_udf("binary")
    def low_bits(m):  # noqa: ANN001, ANN202
        import pandas as pd

        u = np.frombuffer(b"".join(m), np.uint32).reshape(-1, MINIMA) if len(m) else np.zeros((0, MINIMA), np.uint32)
        return pd.Series([x.tobytes() for x in np.packbits((u * np.uint32(0x9E3779B1) >> np.uint32(31)).astype(np.uint8), axis=1)])

    docs = cut(sketches(lines).select("document_id", "minima", low_bits("minima").alias("bits")))
    same = docs.select("document_id", F.unhex(F.sha2("minima", 256)).alias("set"))
    first = same.groupBy("set").agg(F.min("document_id").alias("first"), F.count("*").alias("n")).where("n > 1").select("set", "first")
    copies = cut(same.join(first, "set").where("document_id <> first").select(F.col("first").alias("a"), F.col("document_id").alias("b")))
    reps = docs.join(copies.select(F.col("b").alias("document_id")), "document_id", "left_anti")
    reps = cut(reps.select(F.xxhash64("document_id").alias("doc"), F.col("document_id").alias("first"), "minima", "bits"))
    name = reps.select("doc", "first")
    found = candidates(reps).join(name.select(F.col("doc").alias("a"), F.col("first").alias("x")), "a").join(name.select(F.col("doc").alias("b"), F.col("first").alias("y")), "b")
    pairs = cut(found.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).unionByName(copies))
    return connected_components(verified(lines, pairs)).select(F.col("node").alias("document_id"), F.col("component").alias("group_id"))


def titled_groups(lines: DataFrame, corpus: DataFrame) -> DataFrame:
    """(document_id, group_id, title, title_likeness): the groups beside the documents' titles, and how alike
    each is to the title of the group's first document (``title_similarity``), so that a group under changed
    titles shows. A document that the corpus lacks, or without a title, has a null title and likeness 0."""
    g = cut(like_groups(lines))
    title = corpus.where("document_id is not null").groupBy("document_id").agg(F.max("title").alias("title"))
    lead = title.select(F.col("document_id").alias("group_id"), F.col("title").alias("lead"))
    rows = g.join(title, "document_id", "left").join(lead, "group_id", "left")
    return rows.select("document_id", "group_id", "title", F.round(title_similarity("title", "lead"), 4).alias("title_likeness"))


def found(lines: DataFrame) -> DataFrame:
    """(document_id_a, document_id_b), a < b: the pairs within each group, as asked for: this result itself
    grows with the square of a group."""
    g = cut(like_groups(lines))
    a = g.select("group_id", F.col("document_id").alias("document_id_a"))
    b = g.select("group_id", F.col("document_id").alias("document_id_b"))
    return a.join(b, "group_id").where("document_id_a < document_id_b").select("document_id_a", "document_id_b")
