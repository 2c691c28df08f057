"""Sources mixed to target shares of tokens by balanced sampling (the cube method).

A source that must give r times its tokens uses each of its texts floor(r) times, and a sample of them once more, in
which every text has the inclusion probability r - floor(r). The cube method draws it so that the tokens and the number
of the texts in the sample equal their expectations: it moves the vector of probabilities through the null-space of these
constraints until only a few aren't 0 or 1. It does so in blocks of bounded size, then among what the blocks leave,
until a source has a handful left; landing rounds these. A bounded reserve of small texts, kept out of the flights, then
makes up for the tokens that rounding cost.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vdjlake.llm.tokens import DEFAULT_VOCABULARY, encoding
from vdjlake.storage import cut, discard

#: Texts in a block of a flight: one task's memory.
BLOCK = 20_000
#: Small texts of a source that stay open to the end, about.
RESERVE = 1_000
EPS = 1e-9


def flight(p: np.ndarray, x: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Probabilities after the flight: all 0 or 1 but at most as many as ``x`` has columns, with x'p unchanged.

    p: n; x: n x c, the balancing variables. It works on c + 1 open texts at a time, so it is linear in n.
    """
    p = p.astype(float).copy()
    c = x.shape[1]
    scale = np.maximum(np.abs(x).max(axis=0), EPS) if len(x) else 1.0
    z = x / scale
    waiting = iter(np.flatnonzero((p > EPS) & (p < 1 - EPS)))
    held: list[int] = []
    while True:
        while len(held) <= c:
            k = next(waiting, None)
            if k is None:
                break
            held.append(int(k))
        if len(held) <= 1:
            break
        a = z[held].T
        if len(held) <= c:  # at the end, go on only if these few still leave a direction
            u, s, vt = np.linalg.svd(a)
            rank = int((s > 1e-7).sum())
            if rank >= len(held):
                break
            v = vt[-1]
        else:
            v = np.linalg.svd(a)[2][-1]
        v = np.where(np.abs(v) < 1e-12, 0.0, v)
        q = p[held]
        with np.errstate(divide="ignore", invalid="ignore"):
            up = np.min(np.where(v > 0, (1 - q) / v, np.where(v < 0, -q / v, np.inf)))
            down = np.min(np.where(v > 0, q / v, np.where(v < 0, (q - 1) / v, np.inf)))
        step = up if rng.random() * (up + down) < down else -down
        q = np.clip(q + step * v, 0.0, 1.0)
        q = np.where(q < EPS, 0.0, np.where(q > 1 - EPS, 1.0, q))
        p[held] = q
        held = [k for k in held if 0.0 < p[k] < 1.0]
    return p


def landing(p: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """The few open texts rounded so that tokens are as near to their expectation as can be, then the texts."""
    open_ = np.flatnonzero((p > EPS) & (p < 1 - EPS))
    out = np.round(p)
    if not len(open_):
        return out
    goal, count = float((p * tokens)[open_].sum()), float(p[open_].sum())
    best = min(product((0.0, 1.0), repeat=len(open_)), key=lambda r: (abs(float(np.dot(r, tokens[open_])) - goal), abs(sum(r) - count), r))
    out[open_] = best
    return out


def tilted(q: np.ndarray, t: np.ndarray, tokens: float, texts: float) -> np.ndarray:
    """Probabilities as ``q``, moved by a + b t within 0 and 1 so that ``tokens`` and ``texts`` are expected of them.

    Where no probabilities give both, all are moved alike towards 0 or 1, and the tokens alone are met as nearly as can be.
    """
    z = t / max(float(t.max()), EPS)
    texts = min(max(texts, 0.0), float(len(q)))

    def moved(b: float) -> np.ndarray:
        lo, hi = -1.0 - abs(b), 1.0 + abs(b)
        for _ in range(60):
            a = (lo + hi) / 2
            lo, hi = (a, hi) if np.clip(q + a + b * z, 0.0, 1.0).sum() < texts else (lo, a)
        return np.clip(q + hi + b * z, 0.0, 1.0)

    most = 1e3
    if not float(moved(-most) @ t) <= tokens <= float(moved(most) @ t):
        have, every = float(q @ t), float(t.sum())
        return q * max(tokens, 0.0) / max(have, EPS) if tokens < have else 1 - (1 - q) * max(every - tokens, 0.0) / max(every - have, EPS)
    lo, hi = -most, most
    for _ in range(60):
        b = (lo + hi) / 2
        lo, hi = (b, hi) if float(moved(b) @ t) < tokens else (lo, b)
    return moved(hi)


def settle(p: np.ndarray, tokens: np.ndarray, reserve: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """All texts decided: what flights left open is rounded, and the reserve, still open, makes up for it.

    The reserve's probabilities are first moved so that it is expected to bring the tokens and texts that rounding took
    away or added; then it has its own flight and landing, and the last tokens are sought by swapping
    single texts of it in or out.
    """
    goal = float((p * tokens).sum())
    out = p.copy()
    left = ~reserve
    # a flight leaves two open, so that landing can try all roundings
    out[left] = landing(flight(p[left], np.column_stack([tokens[left], np.ones(left.sum())]), rng), tokens[left])
    r = np.flatnonzero(reserve)
    if not len(r):
        return np.round(out)
    want, t = goal - float((out * tokens)[left].sum()), tokens[r]
    q = tilted(p[r], t, want, float(p.sum() - out[left].sum()))
    order = np.argsort(-t, kind="stable")  # small ones last: what stays open at the end is small
    z = flight(np.clip(q[order], 0.0, 1.0), np.column_stack([t[order], np.ones(len(t))]), rng)
    z = landing(z, t[order])
    for _ in range(50):
        off = want - float(np.dot(z, t[order]))
        change = np.where(z > 0.5, -t[order], t[order])
        k = int(np.argmin(np.abs(off - change)))
        if abs(off - change[k]) >= abs(off):
            break
        z[k] = 1 - z[k]
    out[r[order]] = z
    return np.round(out)


def sized_texts(documents: DataFrame, vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """One row for each different text of a source: source, doc_id (the least), tokens.

    A text repeated under other ids is one text; texts are told apart by two 64-bit hashes, so that only these and the
    tokens are shuffled. Null and blank texts are left out, and rows without a source.
    """
    there = documents.filter(F.col("source").isNotNull() & F.col("text").rlike(r"[^\s\p{Z}]")).select("source", "doc_id", "text")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        e = encoding(vocabulary)
        for b in batches:
            yield b.drop(columns="text").assign(tokens=[len(e.encode_ordinary(t)) for t in b["text"]])

    hashed = there.select("source", "doc_id", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text").alias("h2"), "text")
    sized = hashed.mapInPandas(run, "source string, doc_id bigint, h1 bigint, h2 bigint, tokens bigint")
    return sized.groupBy("source", "h1", "h2").agg(F.min("doc_id").alias("doc_id"), F.min("tokens").alias("tokens")).select("source", "doc_id", "tokens")


def plan(totals: list[tuple[str, int, int]], targets: list[tuple[str, float, int]], size: int | None) -> pd.DataFrame:
    """For each target: share among sources that have texts, wanted tokens and how often the source is used (rate).

    Without ``size``, the mixture is the largest in which no source is used more than its ``max_repeats`` times.
    """
    have = {s: (n, t) for s, n, t in totals}
    frame = pd.DataFrame([(s, float(w), int(m), *have.get(s, (0, 0))) for s, w, m in targets], columns=["source", "target_share", "max_repeats", "texts", "tokens"])
    there = (frame["tokens"] > 0) & (frame["target_share"] > 0) & (frame["max_repeats"] > 0)
    weight = frame["target_share"].where(there, 0.0)
    frame["reachable_share"] = weight / weight.sum() if there.any() else 0.0
    limits = (frame["max_repeats"] * frame["tokens"])[there] / frame["reachable_share"][there]
    most = float(limits.min()) if there.any() else 0.0
    wanted = most if size is None else min(float(size), most)
    frame["wanted_tokens"] = frame["reachable_share"] * wanted
    frame["rate"] = np.where(there, frame["wanted_tokens"] / np.maximum(frame["tokens"], 1), 0.0)
    frame["expected_documents"] = frame["rate"] * frame["texts"]
    return frame


def mix_sources(documents: DataFrame, targets: DataFrame, size: int | None = None, seed: int = 0, vocabulary: str = DEFAULT_VOCABULARY, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """The chosen texts (source, doc_id, tokens, repeats) and the shares reached, one row for each target.

    Beside the shares stand the documents that each source is expected to give, and those it gives.

    Shares are of tokens. A listed source without texts can't give its share; the others keep their proportions
    (``reachable_share``), and ``size`` beyond what the repeats allow is cut to that. Unlisted sources aren't used.
    A source listed twice is an error. Empty tables give no texts and shares of 0.
    """
    listed = [(r["source"], r["target_share"], r["max_repeats"]) for r in targets.select("source", "target_share", "max_repeats").limit(10_001).collect()]
    if len(listed) > 10_000:
        raise ValueError("more than 10000 target sources")
    if len({s for s, _, _ in listed}) != len(listed):
        raise ValueError("a source is listed twice")
    names = [s for s, _, _ in listed]
    spark = documents.sparkSession
    sized = cut(sized_texts(documents.select("doc_id", "source", "text").filter(F.col("source").isin(names)), vocabulary), "sized")
    totals = [tuple(r) for r in sized.groupBy("source").agg(F.count(F.lit(1)), F.sum("tokens")).collect()]
    frame = plan(totals, listed, size)
    rates = spark.createDataFrame([(s, float(r)) for s, r in zip(frame["source"], frame["rate"])] or [], "source string, rate double")
    state = sized.join(F.broadcast(rates), "source").select("source", "doc_id", "tokens", F.floor("rate").alias("whole"), (F.col("rate") - F.floor("rate")).alias("p"))
    sizes = spark.createDataFrame([(s, float(t) / n, min(1.0, 2.0 * RESERVE / n)) for s, n, t in totals] or [], "source string, mean double, portion double")
    by_hash = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 53)) / F.lit(float(1 << 53))
    state = state.join(F.broadcast(sizes), "source").withColumn("reserve", (F.col("tokens") <= F.col("mean")) & (by_hash < F.col("portion"))).drop("mean", "portion")
    state = cut(state, "state")
    columns = ["source", "doc_id", "tokens", "p", "reserve"]
    schema = "source string, doc_id bigint, tokens bigint, p double, reserve boolean"

    def fly(last: bool):
        def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
            rows = rows.sort_values(["tokens", "doc_id"], ascending=[False, True]).reset_index(drop=True)
            p, t = rows["p"].to_numpy(dtype=float), rows["tokens"].to_numpy(dtype=float)
            rng = np.random.default_rng([seed, len(rows), int(rows["doc_id"].abs().max())])
            p = settle(p, t, rows["reserve"].to_numpy(dtype=bool), rng) if last else flight(p, np.column_stack([t, np.ones(len(t))]), rng)
            return rows.assign(p=p)[columns]

        return run

    # flights in blocks of one source, over which its rows are spread evenly by hash, until one block would do
    flights: list[DataFrame] = []
    done, open_ = [], state.filter("NOT reserve").select(*columns)
    most = max([n for _, n, _ in totals], default=0)
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    while most > 12:
        blocks = -(-most // block)
        near = F.pmod(F.xxhash64("doc_id", F.lit(blocks)), F.lit(blocks))
        # a flight is work, not bytes: a number of tasks that isn't lowered for small partitions
        spread = open_.withColumn("__block", near).repartition(tasks, "source", "__block")
        flown = cut(spread.groupBy("source", "__block").applyInPandas(fly(False), schema), "flight")
        flights.append(flown)
        done.append(flown.filter(f"p <= {EPS} OR p >= 1 - {EPS}"))
        open_ = flown.filter(f"p > {EPS} AND p < 1 - {EPS}")
        most = 3 * blocks if blocks > 1 else 0  # three open texts a block at most
    last = open_.unionByName(state.filter("reserve").select(*columns))
    flights.append(cut(last.groupBy("source").applyInPandas(fly(True), schema), "landing"))
    done.append(flights[-1])
    extra = done[0]
    for d in done[1:]:
        extra = extra.unionByName(d)
    chosen = extra.join(F.broadcast(rates), "source").select("source", "doc_id", "tokens", (F.floor("rate") + F.round("p")).cast("int").alias("repeats")).filter("repeats > 0")
    chosen = cut(chosen, "mixture")
    for t in (sized, state, *flights):
        discard(t)
    used = chosen.groupBy("source").agg(F.sum(F.col("tokens") * F.col("repeats")).alias("used_tokens"), F.count(F.lit(1)).alias("used_texts"), F.sum("repeats").alias("used_documents"), F.max("repeats").alias("most_repeats"))
    goals = spark.createDataFrame([(s, float(w), int(m), float(r), float(d)) for s, w, m, r, d in zip(frame["source"], frame["target_share"], frame["max_repeats"], frame["reachable_share"], frame["expected_documents"])] or [], "source string, target_share double, max_repeats int, reachable_share double, expected_documents double")
    total = used.agg(F.sum("used_tokens")).first()[0] or 0
    zero = lambda c: F.coalesce(c, F.lit(0))
    shares = goals.join(used, "source", "left").select(
        "source", "target_share", "reachable_share", "max_repeats", "expected_documents", zero("used_documents").alias("used_documents"), zero("used_texts").alias("used_texts"), zero("most_repeats").alias("most_repeats"),
        zero("used_tokens").alias("used_tokens"), (zero("used_tokens") / F.lit(max(int(total), 1))).alias("actual_share"),
    )
    return chosen, shares
