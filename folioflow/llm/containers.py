"""Problem 7: texts in containers of fixed capacity, by bound-certified repacking."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.session import cut

CAPACITY = 2048
#: The vocabulary that texts are measured in: a file of ranks of a byte-level BPE.
TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
# Fixed value: how that tokenizer family divides a text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Items a partition packs, and rounds of exchange between partitions at most.
ITEMS, ROUNDS = 20_000, 4
#: Share of a container's room from which on its texts are exchanged in any case.
SLACK_SHARE = 0.1
#: Fekete and Schepers' functions that are tried for a bound.
STEPS = 40


def token_counts(documents: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """(doc_id, tokens): the length of each text in tokens; 0 for a null or empty one. The vocabulary file,
    of fixed size, is read once and broadcast."""
    spark = documents.sparkSession
    with open(tokenizer, "rb") as f:
        data = spark.sparkContext.broadcast(f.read())
    kind = documents.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in data.value.splitlines() if x)}
        encode = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        for b in batches:
            n = [len(encode(t)) if t else 0 for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64())], ["doc_id", "tokens"])

    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, tokens bigint")


def lower_bound(sizes: np.ndarray, capacity: int = CAPACITY) -> int:
    return bound_of(np.bincount(sizes, minlength=capacity + 1).astype(np.int64), capacity)


def bound_of(n: np.ndarray, capacity: int = CAPACITY) -> int:
    """Containers that ``n[x]`` items of each size x need at least: the greatest bound over two families of dual
    feasible functions (Martello and Toth; Fekete and Schepers)."""
    x = np.arange(capacity + 1, dtype=np.int64)
    best = -(-int((n * x).sum()) // capacity)
    load, many = np.cumsum(n * x), np.cumsum(n)
    e = np.arange(1, capacity // 2 + 1)
    big = many[-1] - many[capacity - e]
    middle = load[capacity - e] - load[e - 1]
    best = max(best, int((big + -(-middle // capacity)).max()))
    for k in range(1, STEPS + 1):
        whole = (k + 1) * x % capacity == 0
        f = np.where(whole, k * x, (k + 1) * x // capacity * capacity)  # in parts of k * capacity
        best = max(best, -(-int((n * f).sum()) // (k * capacity)))
    return best


def best_fit_decreasing(sizes: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """The container of each item: the largest first, each where the least room is left that takes it. The
    rooms that any container has are the bits of one number, so the fit is found at once."""
    out = np.empty(len(sizes), np.int64)
    rooms: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask, used = 0, 0
    for i in np.argsort(-sizes, kind="stable").tolist():
        s = int(sizes[i])
        fits = mask >> s
        if fits:
            room = s + (fits & -fits).bit_length() - 1
            c = rooms[room].pop()
            if not rooms[room]:
                mask &= ~(1 << room)
        else:
            room, c, used = capacity, used, used + 1
        out[i] = c
        rooms[room - s].append(c)
        mask |= 1 << (room - s)
    return out


def _pack(last: bool, turn: int, capacity: int):
    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["tokens", "doc_id", "piece"], ascending=[False, True, True], kind="stable").reset_index(drop=True)
        sizes = part["tokens"].to_numpy()
        bin_ = best_fit_decreasing(sizes, capacity)
        bins, bound = int(bin_.max()) + 1, lower_bound(sizes, capacity)
        room = capacity - np.bincount(bin_, weights=sizes, minlength=bins)
        give = np.zeros(bins, bool)
        if bins > bound and not last:  # not certified: the emptiest containers are opened and their texts exchanged
            order = np.argsort(-room, kind="stable")[: 8 * (bins - bound) + 8]
            give[order[room[order] > 0]] = True
        if not last:  # certified or not, what is nearly empty can be filled up elsewhere
            give |= room > SLACK_SHARE * capacity
        return pd.DataFrame({"doc_id": part["doc_id"], "piece": part["piece"], "tokens": part["tokens"], "container": [f"{turn}-{p}-{b}" for p, b in zip(part["part"], bin_)], "kept": ~give[bin_], "bound": bound})

    return run


def pack(counts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, tokens, container): ``packed`` without the bounds."""
    return packed(counts, capacity).drop("bound")


def packed(counts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, tokens, container, bound): every text in a container, whole unless it is longer than one,
    beside the least number of containers that all texts of its partition need.

    A longer text fills containers of its own and its rest is one more item. Items are spread over
    partitions of about ITEMS by hash and packed there by best-fit decreasing. A partition that needs no
    more containers than its lower bound is certified; others open their emptiest containers, whose texts
    are exchanged: spread anew over fewer partitions and packed again, ROUNDS times or until one partition
    is left. A text without tokens takes no room: its container is null. No texts: no rows.
    """
    kind = counts.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, tokens bigint, container string, kept boolean, bound bigint"
    unbound = F.lit(None).cast("bigint").alias("bound")
    full = (F.col("tokens") / capacity).cast("int")
    counts = counts.where("doc_id is not null")
    none = counts.where("tokens = 0").select("doc_id", F.lit(0).alias("piece"), "tokens", F.lit(None).cast("string").alias("container"), unbound)
    whole = counts.where(F.col("tokens") >= capacity).select("doc_id", F.explode(F.sequence(F.lit(0), full - 1)).alias("piece"))
    whole = whole.select("doc_id", "piece", F.lit(capacity).cast("bigint").alias("tokens"), F.concat_ws("-", F.lit("full"), "doc_id", "piece").alias("container"), unbound)
    items = counts.where(F.col("tokens") % capacity > 0).select("doc_id", full.alias("piece"), (F.col("tokens") % capacity).alias("tokens"))
    done = [none, whole]
    for turn in range(ROUNDS + 1):
        n = items.count()
        if n == 0:
            break
        parts = -(-n // ITEMS)
        last = parts == 1 or turn == ROUNDS
        spread = items.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece", F.lit(turn)), F.lit(parts)))
        packed = cut(spread.groupBy("part").applyInPandas(_pack(last, turn, capacity), schema))
        done.append(packed.where("kept").drop("kept"))
        if last:
            break
        items = packed.where("not kept").select("doc_id", "piece", "tokens")
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def certificates(counts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(round, partition, containers, bound, texts, tokens, fill): of each partition of each round how many of
    its containers were kept and what its texts needed at least; of longer texts (round ``full``) the containers
    they fill; and of round ``all`` the whole: its bound is that of the sizes of all items together, so
    ``containers`` - ``bound`` is at most what any packing could save."""
    rows = cut(packed(counts, capacity).where("container is not null"))
    name = F.split("container", "-")
    full = name[0] == "full"
    per = rows.groupBy(name[0].alias("round"), F.when(full, "").otherwise(name[1]).alias("partition")).agg(F.countDistinct("container").alias("containers"), F.max("bound").alias("bound"), F.countDistinct("doc_id").alias("texts"), F.sum("tokens").alias("tokens"))
    per = per.withColumn("bound", F.coalesce("bound", "containers"))
    sizes = np.zeros(capacity + 1, np.int64)
    for r in rows.groupBy("tokens").count().collect():  # one row a size, so at most ``capacity``
        sizes[r["tokens"]] = r["count"]
    best = bound_of(sizes, capacity)
    whole = rows.agg(F.lit("all").alias("round"), F.lit("").alias("partition"), F.countDistinct("container").alias("containers"), F.lit(best).cast("bigint").alias("bound"), F.countDistinct("doc_id").alias("texts"), F.sum("tokens").alias("tokens"))
    out = per.unionByName(whole.where("containers > 0"))
    return out.withColumn("fill", F.round(F.col("tokens") / (F.col("containers") * capacity), 4))


def assign(documents: DataFrame, tokenizer: str = TOKENIZER, capacity: int = CAPACITY) -> DataFrame:
    return pack(cut(token_counts(documents, tokenizer)), capacity)
