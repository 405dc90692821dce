"""Problem 8: texts packed into containers of fixed capacity, measured in tokens of a public tokenizer."""

from __future__ import annotations

import base64
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.llm.words import WORD, Hasher, class_ids
from threadloom.session import Stage, collect_bounded

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the published pattern that cuts text into pieces for this byte-level vocabulary.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Items packed together in one task: enough that the last containers of a shard do not matter.
SHARD = 20_000


class Counter(dict):
    """A piece of text to its number of tokens."""

    def __init__(self, ranks: bytes):
        super().__init__()
        table = {base64.b64decode(a): int(b) for a, b in (x.split() for x in ranks.splitlines() if x)}
        self.enc = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})
        self.pieces = regex.compile(PATTERN).findall

    def __missing__(self, piece: str) -> int:
        if len(self) > 500_000:
            self.clear()
        n = self[piece] = len(self.enc.encode_ordinary(piece))
        return n

    def count(self, text: str) -> int:
        return sum(map(self.__getitem__, self.pieces(text)))


def sizes(documents: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """``(doc_id, source, cluster, n_tokens)``; ``cluster`` is equal for texts with the same distinct words, null for texts without words."""
    with open(tokenizer, "rb") as f:
        sent = documents.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, h = Counter(sent.value), Hasher()
        for b in batches:
            texts = [t or "" for t in b.column("text").to_pylist()]
            sets = [{h[w] for w in set(WORD.findall(t.lower()))} for t in texts]
            full = np.array([bool(s) for s in sets], bool)
            cl = np.zeros(len(texts), np.int64)
            if full.any():
                n = np.array([len(s) for s in sets if s])
                cl[full] = class_ids(np.array([x for s in sets for x in s], np.uint64), np.cumsum(n) - n)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("source"), pa.array(cl, mask=~full), pa.array([counter.count(t) for t in texts], pa.int64())], names=["doc_id", "source", "cluster", "n_tokens"]
            )

    d = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.lower(F.trim("source")).alias("source"), F.col("text").cast("string").alias("text"))
    return d.mapInArrow(run, "doc_id bigint, source string, cluster bigint, n_tokens bigint")


def best_fit(size: list[int], source: list, cluster: list, capacity: int) -> list[int]:
    """Container of every item by best fit from the largest down.

    Containers are kept by the room they have left.  From the smallest room that
    suffices, the search goes on to larger ones until a container holds no text of
    the item's duplicate cluster; of those with equal room one without the item's
    source is taken first.  A cluster with more members than there must be containers
    cannot be kept apart: a container then takes as many of it as an even spread over
    those containers gives each, and no more; its members are placed before all else.
    """
    n = len(size)
    must = max(1, math.ceil(sum(size) / capacity))
    members: dict = {}
    for c in cluster:
        if c is not None:
            members[c] = members.get(c, 0) + 1
    c_bit = {c: 1 << i for i, c in enumerate(c for c, k in members.items() if k > 1)}
    most = {c: -(-k // must) for c, k in members.items() if k > must}
    inside: dict[tuple, int] = {}
    s_bit = {s: 1 << i for i, s in enumerate(dict.fromkeys(source))}
    room: dict[int, list[int]] = {}
    has = 0  # bit r is set if a container has room r
    clusters: list[int] = []
    sources: list[int] = []
    out = [0] * n
    for i in sorted(range(n), key=lambda i: (cluster[i] not in most, -size[i])):
        cb, sb, need = c_bit.get(cluster[i], 0), s_bit[source[i]], size[i]
        left = has >> need << need
        took = None
        while left:
            r = (left & -left).bit_length() - 1
            fits = [b for b in room[r] if not clusters[b] & cb] if cb else room[r]
            if fits:
                took = next((b for b in fits if not sources[b] & sb), fits[0])
                break
            left &= left - 1
        if took is None:
            took, r = len(clusters), capacity
            clusters.append(0)
            sources.append(0)
        else:
            room[r].remove(took)
            if not room[r]:
                has ^= 1 << r
        if cluster[i] in most:
            inside[took, cluster[i]] = inside.get((took, cluster[i]), 0) + 1
        if inside.get((took, cluster[i]), 1) >= most.get(cluster[i], 1):
            clusters[took] |= cb
        sources[took] |= sb
        out[i] = took
        rest = r - need
        if rest or need == 0:
            room.setdefault(rest, []).append(took)
            has |= 1 << rest
    return out


def pack(documents: DataFrame, budgets: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """Every document in containers of every budget: ``(budget_name, container_id, doc_id, piece, token_from, token_to)``, see ``_packed``."""
    return _packed(documents, budgets, tokenizer).drop("capacity_tokens")


def _packed(documents: DataFrame, budgets: DataFrame, tokenizer: str) -> DataFrame:
    """``pack`` with the capacity of each container.

    A document is divided only if it exceeds the capacity: into pieces that fill a
    container each and a rest, which is packed like a document.  Documents without
    tokens take no room and are packed too.  Budgets of the same name are told apart
    by capacity; those without a positive capacity get no rows.  Items are spread
    over shards by hash and packed in each by ``best_fit``.
    """
    caps = budgets.where("capacity_tokens > 0 and budget_name is not null").distinct()
    caps = documents.sparkSession.createDataFrame([tuple(r) for r in collect_bounded(caps.select("budget_name", F.col("capacity_tokens").cast("bigint")), 10_000)], "budget_name string, capacity_tokens bigint")
    d = Stage(sizes(documents, tokenizer), "sizes").df
    n = d.count()
    shards = max(1, math.ceil(n / SHARD))
    d = d.withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("int"))
    items = d.join(F.broadcast(caps), F.col("n_tokens") >= 0)
    cap = F.col("capacity_tokens")
    whole = F.floor(F.greatest(F.col("n_tokens") - 1, F.lit(0)) / cap)
    base = F.concat_ws("-", "budget_name", cap.cast("string"))
    items = items.withColumn("whole", whole).withColumn("rest", F.col("n_tokens") - F.col("whole") * cap)
    full = items.where("whole > 0").withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("whole").cast("int") - 1)))
    full = full.select(
        "budget_name", "capacity_tokens", F.concat_ws("-", base, F.lit("doc"), F.col("doc_id").cast("string"), F.col("piece").cast("string")).alias("container_id"), "doc_id", "piece",
        (F.col("piece") * cap).alias("token_from"), ((F.col("piece") + 1) * cap).alias("token_to"),
    )

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        name, capacity, shard = key
        pdf = pdf.sort_values("doc_id", kind="stable")
        got = best_fit(pdf["rest"].tolist(), pdf["source"].tolist(), [None if pd.isna(c) else c for c in pdf["cluster"].tolist()], int(capacity))
        first = pdf["whole"].to_numpy() * capacity
        return pd.DataFrame({
            "budget_name": name, "capacity_tokens": capacity, "container_id": [f"{name}-{capacity}-{shard}-{g}" for g in got], "doc_id": pdf["doc_id"].to_numpy(), "piece": pdf["whole"].to_numpy().astype("int32"),
            "token_from": first, "token_to": first + pdf["rest"].to_numpy(),
        })

    schema = "budget_name string, capacity_tokens bigint, container_id string, doc_id bigint, piece int, token_from bigint, token_to bigint"
    rest = items.select("budget_name", "capacity_tokens", "shard", "doc_id", "source", F.col("cluster").cast("string").alias("cluster"), "whole", "rest")
    return rest.groupBy("budget_name", "capacity_tokens", "shard").applyInPandas(run, schema).unionByName(full)


def pack_report(documents: DataFrame, budgets: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """Per budget: containers, documents, divided documents, tokens, share of room left over, and containers with one lower bound's worth."""
    p = _packed(documents, budgets, tokenizer)
    b = p.groupBy("budget_name", "capacity_tokens", "container_id").agg(F.sum(F.col("token_to") - F.col("token_from")).alias("used"), F.count("*").alias("n"))
    b = b.groupBy("budget_name", "capacity_tokens").agg(F.count("*").alias("n_containers"), F.sum("n").alias("n_items"), F.sum("used").alias("n_tokens"), F.max("used").alias("fullest"))
    return b.withColumn("least_containers", F.ceil(F.col("n_tokens") / F.col("capacity_tokens"))).withColumn("left_over", F.round(1 - F.col("n_tokens") / (F.col("n_containers") * F.col("capacity_tokens")), 6))
