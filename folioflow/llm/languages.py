"""Problem 6: language labels of documents and of the stretches in them, by a linear-chain CRF over words."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.llm.furniture import BODY, Roles, series
from folioflow.llm.lines import doc_chunks, groups, heads_of
from folioflow.llm.quality import ODD, ODD_SHARE, READABLE, character_kinds, common_words, own_words
from folioflow.llm.scans import line_words, words_of
from folioflow.operators.lines import carried, running_total
from folioflow.session import cut

LANGUAGES = ("en", "hi", "mr", "bn", "ta", "fr")
#: Lines in a language from which on a document is written in it.
LEAST_LINES = 5
#: A line counts for its language from this probability on.
SURE = 0.6
#: Training sample: labelled rows a language, taken by hash, and words of each. It bounds the fit, not the use.
TRAIN_ROWS, TRAIN_WORDS = 160, 90
EPOCHS, RATE, DECAY = 6, 0.1, 1e-5
#: A row that the first fit gives to another language, and to its own with at most this probability, is left out.
DOUBT = 0.4
#: Weights of hashed features.
BUCKETS = 1 << 16
#: Training rows of one language that hold a word, from which on the fit vouches for it as readable.
LEXICON_ROWS = 2
#: Words gathered before the chains of many documents are run, and places that run side by side.
GATHER, SIDE_BY_SIDE = 300_000, 200_000

# Names and codes of the languages in labels.
NAMES = {
    "en": ["en", "eng", "english", "अंग्रेज़ी", "anglais"],
    "hi": ["hi", "hin", "hindi", "हिन्दी", "हिंदी"],
    "mr": ["mr", "mar", "marathi", "मराठी"],
    "bn": ["bn", "ben", "bengali", "bangla", "বাংলা"],
    "ta": ["ta", "tam", "tamil", "தமிழ்"],
    "fr": ["fr", "fra", "fre", "french", "français", "francais"],
}


def label_languages(label: Column) -> Column:
    """The languages that a label names, as an array: codes with or without a region, names, and lists of
    either; anything else names nothing."""
    parts = F.split(F.lower(F.coalesce(label, F.lit(""))), r"[+/;,&|]|\band\b|\s+")
    bare = F.transform(parts, lambda x: F.regexp_replace(F.trim(x), r"^([a-z]{2,3})[-_][a-z0-9]{2,8}$", "$1"))
    pairs = [x for lang, names in NAMES.items() for n in names for x in (F.lit(n), F.lit(lang))]
    known = F.create_map(*pairs)
    return F.array_distinct(F.filter(F.transform(bare, lambda x: known[x]), lambda x: x.isNotNull()))


def features(word: str) -> list[int]:
    """Hashed features of a word: itself, affixes, all pairs and triples of letters, and its script."""
    w = f"<{word}>"
    script = min(ord(word[0]) >> 7, 40) if ord(word[0]) > 0x24F else 0
    out = [f"w{word}", *(f"s{k}{script}" for k in range(4))]  # a word's script weighs as much as its letters
    out += [f"p{word[:k]}" for k in (1, 2, 3)] + [f"f{word[-k:]}" for k in (1, 2, 3, 4)]
    out += [f"2{w[i : i + 2]}" for i in range(len(w) - 1)] + [f"3{w[i : i + 3]}" for i in range(len(w) - 2)]
    return [zlib.crc32(x.encode("utf-8", "surrogatepass")) % BUCKETS for x in out]


def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    m = x.max(axis=axis, keepdims=True)
    return (m + np.log(np.exp(x - m).sum(axis=axis, keepdims=True))).squeeze(axis)


def forward_backward(emit: np.ndarray, trans: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of many chains side by side (chain, place, label): log forward and backward scores and the log
    partition of each. Places off the mask, at the chains' ends, pass scores on unchanged."""
    n, t, k = emit.shape
    # scaled probabilities: one matrix product a place
    step = np.exp(trans - trans.max())
    shift = emit.max(axis=2, keepdims=True)
    e = np.exp(emit - shift)
    alpha, beta, scale = np.empty((n, t, k)), np.empty((n, t, k)), np.empty((n, t))
    a = e[:, 0] / e[:, 0].sum(axis=1, keepdims=True)
    alpha[:, 0], scale[:, 0] = a, np.log(e[:, 0].sum(axis=1)) + shift[:, 0, 0]
    for i in range(1, t):
        b = (a @ step) * e[:, i]
        z = b.sum(axis=1, keepdims=True)
        b /= z
        live = mask[:, i, None]
        a = np.where(live, b, a)
        alpha[:, i] = a
        scale[:, i] = np.where(mask[:, i], np.log(z[:, 0]) + shift[:, i, 0] + trans.max(), 0.0)
    b = np.full((n, k), 1.0 / k)
    beta[:, t - 1] = b
    for i in range(t - 2, -1, -1):
        c = (e[:, i + 1] * b) @ step.T
        c /= c.sum(axis=1, keepdims=True)
        b = np.where(mask[:, i + 1, None], c, b)
        beta[:, i] = b
    return alpha, beta, scale


def marginals(emit: np.ndarray, trans: np.ndarray, mask: np.ndarray) -> np.ndarray:
    alpha, beta, _ = forward_backward(emit, trans, mask)
    p = alpha * beta
    return p / p.sum(axis=2, keepdims=True)


class Crf:
    """A linear-chain conditional random field: hashed word features, learned transitions."""

    def __init__(self) -> None:
        k = len(LANGUAGES)
        self.weight = np.zeros((BUCKETS, k))
        self.trans = np.zeros((k, k))
        self.memo: dict[str, np.ndarray] = {}
        self.lexicon: frozenset[str] = frozenset()

    def fit(self, rows: list[tuple[str, str]], seed: int = 7) -> "Crf":
        """Fit on (text, language) rows. Chains are made of stretches of several rows, so that transitions
        between languages are learned. After a first fit, rows that it gives to another language count as
        mislabelled and are left out of the second."""
        rng = np.random.default_rng(seed)
        data = []
        for text, lang in rows:
            w = [x for x in words_of(text) if not x[0].isdigit()][:TRAIN_WORDS]
            if lang in LANGUAGES and len(w) > 4:
                data.append((w, LANGUAGES.index(lang)))
        for keep in (False, True):
            if keep:
                data = [(w, y) for w, y in data if (p := self._line(w)).argmax() == y or p[y] > DOUBT]
            self.weight[:], self.trans[:] = 0, 0
            self._train(data, rng)
            self.memo.clear()
        rows_of = Counter((x, y) for w, y in data for x in set(w) if len(x) > 1)
        self.lexicon = frozenset(x for (x, _), n in rows_of.items() if n >= LEXICON_ROWS)
        return self

    def _line(self, words: list[str]) -> np.ndarray:
        e = np.stack([self.emission(w) for w in words])[None]
        return marginals(e, self.trans, np.ones(e.shape[:2], bool))[0].mean(axis=0)

    def _train(self, data: list[tuple[list[str], int]], rng: np.random.Generator) -> None:
        index: dict[str, int] = {}
        coded = [(np.array([index.setdefault(w, len(index)) for w in words]), y) for words, y in data]
        feats = [np.array(features(w)) for w in index]
        g2w, g2t = np.full(self.weight.shape, 1e-3), np.full(self.trans.shape, 1e-2)
        k = len(LANGUAGES)
        for _ in range(EPOCHS):
            pieces = []
            for n in rng.permutation(len(coded)):
                w, y = coded[n]
                at = 0
                while at < len(w):
                    step = int(rng.integers(8, 60))
                    pieces.append((w[at : at + step], y))
                    at += step
            order = rng.permutation(len(pieces))
            chains, at = [], 0
            while at < len(order):
                step = int(rng.integers(2, 6))
                chains.append([pieces[i] for i in order[at : at + step]])
                at += step
            for c in range(0, len(chains), 64):
                batch = chains[c : c + 64]
                t = max(sum(len(w) for w, _ in x) for x in batch)
                ids, gold, mask = np.zeros((len(batch), t), int), np.zeros((len(batch), t), int), np.zeros((len(batch), t), bool)
                for i, x in enumerate(batch):
                    n = sum(len(w) for w, _ in x)
                    ids[i, :n] = np.concatenate([w for w, _ in x])
                    gold[i, :n] = np.repeat([y for _, y in x], [len(w) for w, _ in x])
                    mask[i, :n] = True
                # each different word of the batch has its features summed once, and its errors taken apart once
                words, place = np.unique(ids, return_inverse=True)
                place = place.reshape(ids.shape)
                many = np.array([len(feats[w]) for w in words])
                flat = np.concatenate([feats[w] for w in words])
                emit = np.add.reduceat(self.weight[flat], np.cumsum(many) - many, axis=0)[place]
                emit[~mask] = 0
                alpha, beta, _ = forward_backward(emit, self.trans, mask)
                p = alpha * beta
                p /= p.sum(axis=2, keepdims=True)
                err = p.copy()
                np.put_along_axis(err, gold[..., None], np.take_along_axis(err, gold[..., None], 2) - 1, 2)
                err[~mask] = 0
                each = np.stack([np.bincount(place.ravel(), err[..., y].ravel(), len(words)) for y in range(k)], axis=1)
                used, at = np.unique(flat, return_inverse=True)  # only features of this batch change
                each = np.repeat(each, many, axis=0)
                gw = np.stack([np.bincount(at, each[:, y], len(used)) for y in range(k)], axis=1)
                both = mask[:, 1:]
                shift = emit.max(axis=2, keepdims=True)
                right = np.exp(emit - shift)[:, 1:] * beta[:, 1:]
                pair = alpha[:, :-1, :, None] * np.exp(self.trans)[None, None] * right[:, :, None, :]
                pair /= pair.sum(axis=(2, 3), keepdims=True)
                gt = pair[both].sum(axis=0)
                np.subtract.at(gt, (gold[:, :-1][both], gold[:, 1:][both]), 1)
                gw, gt = gw / len(batch) + DECAY * self.weight[used], gt / len(batch)
                g2w[used] += gw * gw
                g2t += gt * gt
                self.weight[used] -= RATE * gw / np.sqrt(g2w[used])
                self.trans -= RATE * gt / np.sqrt(g2t)

    def emission(self, word: str) -> np.ndarray:
        e = self.memo.get(word)
        if e is None:
            if len(self.memo) > 300_000:
                self.memo.clear()
            e = self.memo[word] = self.weight[features(word)].sum(axis=0)
        return e

    def word_marginals(self, chains: list[list[str]]) -> np.ndarray:
        """Probabilities of the languages for each word of each chain, one row a word in order. A chain of any
        length runs whole; chains of like length run side by side."""
        index: dict[str, int] = {}
        ids = [np.array([index.setdefault(w, len(index)) for w in c], int) for c in chains]
        if not index:
            return np.zeros((0, len(LANGUAGES)))
        table = np.stack([self.emission(w) for w in index])
        out: list[np.ndarray] = [table[:0]] * len(ids)
        order = sorted(range(len(ids)), key=lambda n: len(ids[n]))
        while order:
            t = len(ids[order[-1]])
            some = order[-max(1, SIDE_BY_SIDE // max(t, 1)) :]
            del order[-len(some) :]
            emit, mask = np.zeros((len(some), t, len(LANGUAGES))), np.zeros((len(some), t), bool)
            for i, n in enumerate(some):
                emit[i, : len(ids[n])] = table[ids[n]]
                mask[i, : len(ids[n])] = True
            if t:
                p = marginals(emit, self.trans, mask)
                for i, n in enumerate(some):
                    out[n] = p[i, : len(ids[n])]
        return np.concatenate(out)


def training_rows(documents: DataFrame) -> list[tuple[str, str]]:
    """The bounded training sample: TRAIN_ROWS labelled texts a language, by hash of the id. Ids are chosen
    first, so that each task offers only ids; the chosen texts alone come to the driver."""
    ids: list[int] = []
    for lang in LANGUAGES:
        chosen = documents.where((F.col("lang") == lang) & F.col("doc_id").isNotNull()).select("doc_id", F.xxhash64("doc_id").alias("h"))
        ids += [r["doc_id"] for r in chosen.orderBy("h", "doc_id").limit(TRAIN_ROWS).collect()]
    rows = documents.where(F.col("doc_id").isin(ids) & F.col("text").isNotNull()).select("doc_id", "text", "lang").collect() if ids else []
    return [(r["text"], r["lang"]) for r in sorted(rows, key=lambda r: (r["lang"] or "", r["doc_id"], r["text"]))]


def fit(documents: DataFrame) -> Crf:
    return Crf().fit(training_rows(documents))


_LINES = "document_id string, stream_index int, language string, confidence double"


def line_languages(lines: DataFrame, model: Crf) -> DataFrame:
    """(document_id, stream_index, language, confidence): the language of each line of running text, with
    the mean probability of its words. The chain runs over all words of a chunk, so that short lines take
    the language around them. Running heads and feet, page numbers, notes, lines without words and lines
    that aren't readable (junk) have no row. Words that the training rows share are readable, and words that a
    chunk uses again and again (``own_words``), so that a language in few documents is read too."""
    common = common_words(lines) | model.lexicon
    shared = lines.sparkSession.sparkContext.broadcast((model.weight.astype(np.float32), model.trans, common))
    names = np.array(LANGUAGES, object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crf = Crf.__new__(Crf)
        crf.weight, crf.trans, readable = shared.value
        crf.memo = {}
        roles = Roles()
        chains: list[list[str]] = []
        ids: list[str] = []
        at: list[int] = []
        size: list[int] = []
        held = 0

        def flush() -> pa.RecordBatch:
            p = crf.word_marginals(chains)
            begin = np.cumsum([0, *size[:-1]]) if size else np.zeros(0, int)
            total = np.add.reduceat(p, begin, axis=0) / np.array(size)[:, None] if size else np.zeros((0, len(LANGUAGES)))
            best = total.argmax(axis=1)
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(at, pa.int32()), pa.array(names[best], pa.string()), pa.array(total[np.arange(len(best)), best], pa.float64())], ["document_id", "stream_index", "language", "confidence"])

        for b in batches:
            for heads, (did, page, index, texts, ahead) in zip(heads_of(b), groups(b)):
                role = roles.of(did, page, texts, heads)
                kind, off = character_kinds(texts)
                odd = np.add.reduceat(kind == ODD, off[:-1], dtype=np.int64).tolist() if texts else []
                chain: list[str] = []
                tokens = line_words(texts)
                own = own_words(tokens, readable)
                for i, t in enumerate(texts):
                    if role[i] != BODY or ahead[i] or odd[i] > ODD_SHARE * len(t):
                        continue
                    words = [w for w in tokens[i] if w[0].isalpha()]
                    if not words or len([w for w in words if w in readable or w in own]) < READABLE * len(words):
                        continue
                    chain += words
                    ids.append(did)
                    at.append(index[i])
                    size.append(len(words))
                if chain:
                    chains.append(chain)
                    held += len(chain)
            if held >= GATHER:
                yield flush()
                chains, ids, at, size, held = [], [], [], [], 0
        if chains:
            yield flush()

    return doc_chunks(lines, heads=series(lines)).select("document_id", "lines").mapInArrow(run, _LINES)


def document_languages(lines: DataFrame, model: Crf) -> DataFrame:
    """(document_id, language, lines, confidence): the languages of each document with at least LEAST_LINES
    lines in it that it has with probability SURE or more. Lines are counted in the tasks that label them
    first."""
    per = line_languages(lines, model).where(F.col("confidence") >= SURE).groupBy("document_id", "language").agg(F.count("*").alias("lines"), F.avg("confidence").alias("confidence"))
    return per.where(F.col("lines") >= LEAST_LINES)


def segments(lines: DataFrame, model: Crf) -> DataFrame:
    """(document_id, first_index, last_index, language, lines, confidence): the stretches of each document, in
    order, whose lines are in one language, with the mean confidence of the lines. Lines that have no language
    (``line_languages``), or one with less than SURE, end no stretch and belong to none. Stretches are told
    over buckets of lines, so a document of any size is many tasks' work."""
    per = cut(line_languages(lines, model).where(F.col("confidence") >= SURE))
    rows = carried(per, "document_id", "stream_index", {"before": F.col("language")}, own=False)
    fresh = (~F.col("before").eqNullSafe(F.col("language"))).cast("int")
    rows = running_total(rows.withColumn("fresh", fresh), "document_id", "stream_index", F.col("fresh"), "segment").withColumn("segment", F.col("segment") + F.col("fresh"))
    ends = F.min("stream_index").alias("first_index"), F.max("stream_index").alias("last_index")
    return rows.groupBy("document_id", "segment", "language").agg(*ends, F.count("*").alias("lines"), F.round(F.avg("confidence"), 4).alias("confidence")).drop("segment")


def unnamed(lines: DataFrame, corpus: DataFrame, inventory: DataFrame, model: Crf) -> DataFrame:
    """(document_id, language): languages of a document that its corpus label or its latest inventory label
    doesn't name. A null or meaningless label names nothing; a document that a table lacks is not held
    against that table, one that both lack is given with all its languages."""
    said = corpus.where("document_id is not null").groupBy("document_id").agg(F.max_by("language", "downloaded_at").alias("language"))
    last = inventory.where("document_id is not null").groupBy("document_id").agg(F.max_by("language", F.coalesce("discovered_at", F.lit("1900-01-01").cast("timestamp"))).alias("language"))
    said = said.select("document_id", label_languages(F.col("language")).alias("said"))
    last = last.select("document_id", label_languages(F.col("language")).alias("last"))
    rows = document_languages(lines, model).select("document_id", "language").join(said, "document_id", "left").join(last, "document_id", "left")
    misses = lambda c: F.col(c).isNotNull() & ~F.array_contains(c, F.col("language"))
    return rows.where(misses("said") | misses("last") | (F.col("said").isNull() & F.col("last").isNull())).select("document_id", "language")
