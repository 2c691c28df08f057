"""Texts packed into containers of fixed token capacity by lexical retrieval.

The texts are spread over shards of bounded size. A shard holds a BM25 inverted index of its texts, whose document
frequencies and mean length are those of all documents. The largest unused text seeds a container; its best-scoring
unused neighbours fill the window; what fits most closely is taken only when no neighbour with a score fits. What a shard leaves in
containers that aren't full enough is packed again together with what other shards leave.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vdjlake.llm.tokens import DEFAULT_VOCABULARY, encoding, vocabulary_size
from vdjlake.storage import cut, discard

#: Bounds of a shard: texts, and tokens that they have together.
SHARD_TEXTS, SHARD_TOKENS = 4096, 4_000_000
#: Containers filled less than this are dissolved and packed again with those of other shards.
FULL_ENOUGH = 0.99
K1, B = 1.2, 0.75
#: The best-scoring neighbours that are put in order at first; all others only where these leave room.
FIRST = 256
OUT = "container_kind string, container_id string, doc_id bigint, piece_no int, start_token bigint, n_tokens bigint, score double, chance double, fill double"


def term_counts(documents: DataFrame, vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """doc_id, n_tokens, terms (distinct token ids) and tf of every text with a token; null and empty ones have none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        e = encoding(vocabulary)
        for b in batches:
            counted = [(d, len(ids := e.encode_ordinary(t)), *np.unique(np.asarray(ids, dtype=np.int32), return_counts=True)) for d, t in zip(b["doc_id"], b["text"])]
            yield pd.DataFrame({"doc_id": [c[0] for c in counted], "n_tokens": [c[1] for c in counted], "terms": [c[2] for c in counted], "tf": [c[3].astype(np.int32) for c in counted]})

    return documents.select("doc_id", "text").filter("length(text) > 0").mapInPandas(run, "doc_id bigint, n_tokens bigint, terms array<int>, tf array<int>")


class Index:
    """BM25 over the texts of one shard, with statistics of all documents."""

    def __init__(self, terms: Sequence[np.ndarray], tf: Sequence[np.ndarray], idf: np.ndarray, mean: float):
        sizes = np.fromiter(map(len, terms), dtype=np.int64, count=len(terms))
        self.terms = terms
        flat = np.concatenate(terms).astype(np.int64) if len(terms) else np.empty(0, np.int64)
        f = np.concatenate(tf).astype(float) if len(tf) else np.empty(0)
        doc = np.repeat(np.arange(len(terms)), sizes)
        length = np.bincount(doc, weights=f, minlength=len(terms)) if len(f) else np.zeros(len(terms))
        w = idf[flat] * f * (K1 + 1) / (f + K1 * (1 - B + B * length[doc] / max(mean, 1e-9)))
        order = np.argsort(flat, kind="stable")
        self.known, first = np.unique(flat[order], return_index=True)
        self.ends = np.append(first, len(flat))
        self.doc, self.w, self.n = doc[order], w[order], len(terms)

    def scores(self, seed: int) -> np.ndarray:
        """Score of every text of the shard for the terms of text ``seed``."""
        at = np.searchsorted(self.known, self.terms[seed])
        lo, hi = self.ends[at], self.ends[at + 1]
        n = hi - lo
        where = np.repeat(lo - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
        return np.bincount(self.doc[where], weights=self.w[where], minlength=self.n)


def scored_fill(sizes: np.ndarray, of_text: np.ndarray, index: Index, capacity: int) -> list[list[tuple[int, float | None, float | None]]]:
    """Containers as lists of (item, score, chance). ``of_text``: the text in the index that each item is (a piece of).

    ``score`` is an item's BM25 for the seed of its container, ``chance`` the mean of all texts of the shard for that
    seed. The seed itself has neither, nor have items of a container that nothing else fitted into.
    """
    order = np.lexsort((np.arange(len(sizes)), sizes))
    by_size = [(int(sizes[k]), int(k)) for k in order]  # ascending; taken items are removed
    free = np.ones(len(sizes), dtype=bool)
    containers = []

    def take(k: int) -> int:
        free[k] = False
        del by_size[bisect_left(by_size, (int(sizes[k]), k))]
        return int(sizes[k])

    while by_size:
        seed = by_size[-1][1]
        left = capacity - take(seed)
        inside: list[tuple[int, float | None, float | None]] = [(seed, None, None)]
        if by_size and by_size[0][0] <= left:
            every = index.scores(int(of_text[seed]))
            score, chance = every[of_text], float(every.mean())
            near = np.flatnonzero(free & (sizes <= left) & (score > 0))
            bar = np.partition(score[near], len(near) - FIRST)[len(near) - FIRST] if len(near) > FIRST else 0.0
            for part in (near[score[near] >= bar], near[score[near] < bar]):
                part = part[np.argsort(-score[part], kind="stable")]
                at = 0
                while at < len(part) and by_size and by_size[0][0] <= left:
                    # as many in order as fit, then the next that fits
                    n = int(np.searchsorted(np.cumsum(sizes[part[at:]]), left, side="right"))
                    for k in part[at : at + n]:
                        inside.append((int(k), float(score[k]), chance))
                        left -= take(int(k))
                    fits = np.flatnonzero(sizes[part[at + n :]] <= left)
                    at = at + n + int(fits[0]) if len(fits) else len(part)
            while by_size and by_size[0][0] <= left:
                k = by_size[bisect_right(by_size, (left, len(sizes))) - 1][1]
                inside.append((k, float(score[k]), chance))
                left -= take(k)
        containers.append(inside)
    return containers


def fill(sizes: np.ndarray, of_text: np.ndarray, index: Index, capacity: int) -> list[list[int]]:
    """Containers as lists of items."""
    return [[k for k, _, _ in inside] for inside in scored_fill(sizes, of_text, index, capacity)]


def pack_texts(documents: DataFrame, budgets: Sequence[tuple[str, int]], vocabulary: str = DEFAULT_VOCABULARY, shard_texts: int = SHARD_TEXTS, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """A row for each kind and text (or piece): container_kind, container_id, doc_id, piece_no, start_token, n_tokens, score, chance.

    ``budgets``: kinds with their capacities in tokens. A text is cut only if it exceeds the capacity, into pieces of
    exactly the capacity, each alone in a container, and a rest that is packed like a text; pieces are token ranges.
    Null and empty texts have no tokens and no container. ``doc_id`` must be unique. Texts repeated under another id
    are packed like any. What the driver holds are the document frequencies of the vocabulary's tokens. Texts of which
    no two fit together can't fill containers however often they are packed: shards are never made fewer
    than their bounds ask for, and packing again ends where it no longer lessens them by a quarter.
    """
    if any(c < 1 for _, c in budgets):
        raise ValueError("capacities must be positive")
    counted = cut(term_counts(documents, vocabulary), "terms")
    texts, tokens = counted.agg(F.count(F.lit(1)), F.sum("n_tokens")).first()
    texts, tokens = int(texts), int(tokens or 0)
    spark = documents.sparkSession
    if not texts:
        return spark.createDataFrame([], OUT).drop("fill")
    df = np.zeros(vocabulary_size(vocabulary))
    for r in counted.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("n")).toPandas().itertuples():
        df[r.t] = r.n
    idf = spark.sparkContext.broadcast(np.log1p((texts - df + 0.5) / (df + 0.5)))  # a number for each token of the vocabulary
    mean = tokens / texts

    def packer(stage: int):
        def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
            rows = rows.sort_values("doc_id").reset_index(drop=True)
            index = Index(list(rows["terms"]), list(rows["tf"]), idf.value, mean)
            out: list[tuple] = []
            for kind, capacity in budgets:
                if stage and kind != key[0]:
                    continue
                name = f"{kind}-{stage}-{key[-1]}"
                n = rows["n_tokens"].to_numpy(dtype=np.int64)
                ids = rows["doc_id"].to_numpy()
                if stage:
                    size, text, piece, start = n, np.arange(len(n)), rows["piece_no"].to_numpy(), rows["start_token"].to_numpy()
                else:
                    whole = n // capacity  # pieces that are full by themselves
                    cut_up = n > capacity
                    for k in np.flatnonzero(cut_up):
                        out += [(kind, f"{kind}-w-{ids[k]}-{j}", ids[k], j, j * capacity, capacity, None, None, 1.0) for j in range(whole[k])]
                    size = np.where(cut_up, n - whole * capacity, n)
                    text = np.flatnonzero(size > 0)
                    piece, start, size = np.where(cut_up, whole, 0)[text], np.where(cut_up, whole * capacity, 0)[text], size[text]
                for i, inside in enumerate(scored_fill(size, text, index, capacity)):
                    share = float(sum(size[k] for k, _, _ in inside)) / capacity
                    out += [(kind, f"{name}-{i}", ids[text[k]], piece[k], start[k], size[k], score, chance, share) for k, score, chance in inside]
            return pd.DataFrame(out, columns=[c.split()[0] for c in OUT.split(", ")])

        return run

    shards = max(1, -(-texts // shard_texts), -(-tokens // shard_tokens))
    shard = F.pmod(F.xxhash64("doc_id"), F.lit(shards)).alias("__shard")
    packed = cut(counted.groupBy(shard).applyInPandas(packer(0), OUT), "packed")
    done, stage = [], 0
    while shards > 1:
        left = packed.filter(F.col("fill") < FULL_ENOUGH).select("container_kind", "doc_id", "piece_no", "start_token", "n_tokens")
        sizes = left.groupBy("container_kind").agg(F.count(F.lit(1)).alias("n"), F.sum("n_tokens").alias("t"))
        n, t = sizes.agg(F.max("n"), F.max("t")).first()
        needed = max(1, -(-(n or 0) // shard_texts), -(-(t or 0) // shard_tokens))
        if not n or needed > max(1, 0.75 * shards):
            break
        stage, shards = stage + 1, needed
        done.append(packed.filter(F.col("fill") >= FULL_ENOUGH))
        again = left.join(counted.select("doc_id", "terms", "tf"), "doc_id")
        shard = F.pmod(F.xxhash64("doc_id", F.lit(stage)), F.lit(shards)).alias("__shard")
        packed = cut(again.groupBy("container_kind", shard).applyInPandas(packer(stage), OUT), "packed")
    discard(counted)
    done.append(packed)
    result = done[0]
    for d in done[1:]:
        result = result.unionByName(d)
    return result.drop("fill")


def container_use(packed: DataFrame, budgets: Sequence[tuple[str, int]]) -> DataFrame:
    """Containers, tokens, unused space and relatedness of each kind.

    ``mean_score`` is the mean BM25 of texts for the seeds of their containers, ``mean_chance`` what texts at random have.
    """
    sizes = packed.sparkSession.createDataFrame([(k, int(c)) for k, c in budgets], "container_kind string, capacity_tokens int")
    by = packed.groupBy("container_kind").agg(F.count_distinct("container_id").alias("containers"), F.sum("n_tokens").alias("tokens"), F.avg("score").alias("mean_score"), F.avg("chance").alias("mean_chance"))
    return sizes.join(by, "container_kind", "left").select(
        "container_kind", "capacity_tokens", F.coalesce("containers", F.lit(0)).alias("containers"), F.coalesce("tokens", F.lit(0)).alias("tokens"),
        (1 - F.col("tokens") / (F.col("containers") * F.col("capacity_tokens"))).alias("unused_share"),
        "mean_score", "mean_chance",
    )
