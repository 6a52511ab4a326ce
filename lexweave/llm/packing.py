"""Filling fixed-capacity containers with documents at target token proportions per source."""

from __future__ import annotations

import base64
import re
from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import cut_lineage

#: Tokens of one shard, the unit that one task packs.
SHARD_TOKENS = 16_000_000
#: Containers per window over which proportions are balanced.
WINDOW = 256
#: Sources with their own queue; further ones, by falling size, share a queue.
QUEUES = 64
#: Characters handed to the tokenizer at once; longer texts are cut at white space before a word, where this tokenizer cuts too.
STRETCH = 100_000

_BREAK = re.compile(r"(?<=\S) (?=[^\W\d_])")
_ENCODERS: dict[str, object] = {}


def encoder(path: str):
    """The byte-level BPE encoder of a ranks file (lines of base64 token and rank); one per process."""
    if path not in _ENCODERS:
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        _ENCODERS[path] = tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _ENCODERS[path]


def default_tokenizer() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.tiktoken"))


def stretches(text: str, size: int = STRETCH) -> Iterator[str]:
    """The text in stretches of ``size`` characters or more, each but the first beginning with a single blank before a letter; the
    tokenizer's pattern never joins the blank to what stands before it, so the tokens are those of the whole text. Where there is no
    such place the stretch goes on, to the end of the text if need be."""
    at = 0
    while len(text) - at > size and (place := _BREAK.search(text, at + size)):
        yield text[at : place.start()]
        at = place.start()
    yield text[at:]


def count_tokens(df: DataFrame, text: str, tokenizer: str, keep: list[str]) -> DataFrame:
    """The ``keep`` columns and ``n_tokens`` (long). Null and empty texts have none; texts naming special tokens are ordinary text."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(tokenizer)
        for batch in batches:
            n = [sum(len(enc.encode_ordinary(s)) for s in stretches(t)) if t else 0 for t in batch.pop("_text")]
            yield batch.assign(n_tokens=np.array(n, dtype="int64"))

    src = df.select(*keep, F.col(text).alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1])
    return src.mapInPandas(count, f"{schema}, n_tokens long")


def pack_shard(items: list[tuple[int, int, int, int]], shares: dict[int, float], deficits: dict[int, float], capacity: int, window: int = WINDOW) -> list[tuple[int, int, int]]:
    """Packs (key, piece, queue, size) items of one shard; per item, in the same order: container, offset, window.

    Deficit round-robin: each window's tokens are granted to the queues by their shares of what is still waiting to be balanced; a
    queue sends items while its deficit covers them, and what it didn't use, or overdrew, is carried into the next window. A window's
    items go largest first into the open container with the least room that still holds them; containers with room stay open for
    the windows after it.
    """
    queues: dict[int, deque[int]] = {q: deque() for q in shares}
    for n, item in enumerate(items):
        queues[item[2]].append(n)
    owed = {q: deficits.get(q, 0.0) for q in queues}
    placed: list[tuple[int, int, int]] = [(0, 0, 0)] * len(items)
    rooms: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_rooms = 0  # bit r is set where a container with room r is open
    used: list[int] = []
    turn = 0
    while any(queues.values()):
        waiting = {q: shares[q] for q, line in queues.items() if line}
        whole = sum(waiting.values()) or 1.0
        budget = window * capacity
        chosen: list[int] = []
        for q in waiting:
            owed[q] += budget * (waiting[q] / whole if sum(waiting.values()) else 1 / len(waiting))
        sent = True
        while sent:  # rounds, one item per queue and round, so that sources alternate inside a window
            sent = False
            for q in waiting:
                line = queues[q]
                if line and budget > 0 and items[line[0]][3] <= owed[q]:
                    n = line.popleft()
                    owed[q] -= items[n][3]
                    budget -= items[n][3]
                    chosen.append(n)
                    sent = True
        if not chosen:  # every queue is overdrawn: the least overdrawn sends one item
            q = max(waiting, key=lambda w: owed[w])
            n = queues[q].popleft()
            owed[q] -= items[n][3]
            chosen.append(n)
        for q, line in queues.items():
            if not line:
                owed[q] = min(owed[q], 0.0)  # nothing is saved up for an empty queue
        for n in sorted(chosen, key=lambda n: -items[n][3]):
            size = items[n][3]
            fits = open_rooms >> size
            if fits:
                room = size + (fits & -fits).bit_length() - 1
                box = rooms[room].pop()
                if not rooms[room]:
                    open_rooms &= ~(1 << room)
            else:
                box, room = len(used), capacity
                used.append(0)
            placed[n] = (box, used[box], turn)
            used[box] += size
            rooms[room - size].append(box)
            open_rooms |= 1 << (room - size)
        turn += 1
    return placed


def pack_documents(
    df: DataFrame, doc_id: str, text: str, source: str, tokenizer: str | None = None, capacity: int = 2048,
    targets: dict[str, float] | None = None, shard_tokens: int = SHARD_TOKENS, window: int = WINDOW,
) -> DataFrame:
    """Every document's place: ``doc_id, piece, source, container, offset, n_tokens, window, shard``.

    Containers hold ``capacity`` tokens of the public tokenizer in the ranks file ``tokenizer``. A document stays whole unless it alone
    exceeds a container; then it is cut into pieces of ``capacity`` tokens and a rest, numbered from 1. Documents without tokens
    (null, empty) get a place of size 0. ``container`` is unique over all shards, windows are numbered within each.

    ``targets`` maps sources to shares of tokens (others share what is left by their size); by default every source's share of the
    corpus. Documents are spread over shards by a hash of id and text, whatever their source, so a source of any size is worked by
    all tasks and a shard holds about ``shard_tokens`` tokens. Each shard starts from the deficits that the shards before it
    leave: what they held of a source less its part of the corpus, known from per-shard totals without waiting for them (one row for each
    ``shard_tokens`` tokens, the only rows that one task sums). A target beyond a source's part of the corpus ends with the source's
    documents in each shard, and nothing of it is carried.

    A null source is a source of its own. Null or repeated ids: packed row by row like others. An empty table gives no rows.
    Every source in ``targets`` has a queue of its own; the largest others fill up to ``QUEUES``, the rest share one. Other columns are ignored.
    """
    path = tokenizer or default_tokenizer()
    src = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"), F.col(source).isNull().alias("unnamed"), F.col(text).alias("text"))
    # rows without id, and copies under one id, spread over all shards like others
    mark = F.xxhash64("doc_id", "text", F.when(F.col("doc_id").isNull(), F.rand(7)))
    counted = cut_lineage(count_tokens(src.withColumn("mark", mark), "text", path, ["doc_id", "source", "unnamed", "mark"]))  # tokenized once, whatever is lost later
    per_source = counted.groupBy("source", "unnamed").agg(F.sum("n_tokens").alias("tokens"))
    named = F.col("source").isin(*(targets or {})) & ~F.col("unnamed")
    totals = per_source.orderBy(named.desc(), F.desc("tokens"), "source", "unnamed").limit(max(QUEUES, len(targets or {}))).collect()
    grand = per_source.agg(F.sum("tokens")).first()[0] or 0
    shards = max(1, -(-grand // shard_tokens))
    tokens = [r["tokens"] for r in totals]
    tokens.append(max(0, grand - sum(tokens)))
    shares = _shares([None if r["unnamed"] else r["source"] for r in totals] + [None], tokens, targets)
    queue = F.lit(len(totals))
    for n, r in enumerate(totals):
        queue = F.when((F.col("source") == r["source"]) & (F.col("unnamed") == r["unnamed"]), n).otherwise(queue)
    shard = F.pmod(F.xxhash64("mark", F.lit(5)), F.lit(shards)).cast("int")
    placed = counted.select("doc_id", F.when(~F.col("unnamed"), F.col("source")).alias("source"), "n_tokens", queue.cast("int").alias("queue"), shard.alias("shard"))
    # what the shards before owe each queue: one row per shard, whatever the number of documents
    by_shard = placed.groupBy("shard").agg(F.sum("n_tokens").alias("all"), *(F.coalesce(F.sum(F.when(F.col("queue") == q, F.col("n_tokens"))), F.lit(0)).alias(f"q{q}") for q in range(len(shares))))
    before = W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    usual = [t / max(1, grand) for t in tokens]
    owed = [F.coalesce(F.sum("all").over(before) * u - F.sum(f"q{q}").over(before), F.lit(0.0)).cast("double") for q, u in enumerate(usual)]
    carried = by_shard.select("shard", F.array(*owed).alias("owed"))

    def pack(rows: pd.DataFrame, start: pd.DataFrame) -> pd.DataFrame:
        if rows.empty:
            return pd.DataFrame(columns=["doc_id", "piece", "source", "container", "offset", "n_tokens", "window", "shard"])
        here = int(rows["shard"].iloc[0])
        rows = rows.sort_values(["doc_id", "n_tokens"], kind="stable").reset_index(drop=True)
        items, origin = [], []
        for r, (n, q) in enumerate(zip(rows["n_tokens"].to_numpy(), rows["queue"].to_numpy(), strict=True)):
            for piece, at in enumerate(range(0, max(int(n), 1), capacity), 1):
                items.append((r, piece, int(q), min(capacity, int(n) - at)))
                origin.append(r)
        out = pack_shard(items, dict(enumerate(shares)), dict(enumerate(start["owed"].iloc[0])), capacity, window)
        got = rows.iloc[origin][["doc_id", "source"]].reset_index(drop=True)
        return got.assign(
            piece=np.array([i[1] for i in items], dtype="int32"), container=np.array([p[0] for p in out], dtype="int64") * shards + here, offset=np.array([p[1] for p in out], dtype="int32"),
            n_tokens=np.array([i[3] for i in items], dtype="int32"), window=np.array([p[2] for p in out], dtype="int32"), shard=np.full(len(out), here, dtype="int32"),
        )[["doc_id", "piece", "source", "container", "offset", "n_tokens", "window", "shard"]]

    return placed.groupBy("shard").cogroup(carried.groupBy("shard")).applyInPandas(pack, "doc_id long, piece int, source string, container long, offset int, n_tokens int, window int, shard int")


def _shares(names: list[str | None], tokens: list[int], targets: dict[str, float] | None) -> list[float]:
    """Target share of each queue: as given, what is left by size."""
    given = [(targets or {}).get(n) if n is not None else None for n in names]
    rest = max(0.0, 1.0 - sum(g for g in given if g is not None))
    size = sum(t for t, g in zip(tokens, given, strict=True) if g is None) or 1
    return [g if g is not None else rest * t / size for t, g in zip(tokens, given, strict=True)]


def packing_report(packed: DataFrame, capacity: int = 2048) -> DataFrame:
    """Per source: documents, pieces, tokens, share of all tokens; and for all containers their number and the share left unused."""
    boxes = packed.groupBy("container").agg(F.sum("n_tokens").alias("tokens")).agg(F.count(F.lit(1)).alias("n_containers"), (1 - F.sum("tokens") / (F.count(F.lit(1)) * capacity)).alias("unused_share"))
    per = packed.groupBy("source").agg(F.count_if(F.col("piece") == 1).alias("n_docs"), F.count(F.lit(1)).alias("n_pieces"), F.sum("n_tokens").cast("long").alias("n_tokens"))
    total = F.sum("n_tokens").over(W.partitionBy(F.lit(1)))
    return per.withColumn("token_share", F.col("n_tokens") / total).join(F.broadcast(boxes), how="cross")


def packing_faults(packed: DataFrame, targets: dict[str, float], capacity: int = 2048, window: int = WINDOW, slack: float = 0.02) -> DataFrame:
    """One row that counts what a packing must not have: documents placed in more than one piece though they fit a container, containers
    over capacity, pieces that overlap or leave a hole within a container, and windows in which a source with a target, while all sources
    still wait, is off its part of the window's ``window`` containers by more than ``slack`` and one container; with the numbers of documents and tokens placed."""
    order = W.partitionBy("container").orderBy("offset", "n_tokens")
    at = packed.select("*", F.coalesce(F.lag(F.col("offset") + F.col("n_tokens")).over(order), F.lit(0)).alias("_free"))
    boxes = at.groupBy("container").agg(F.sum("n_tokens").alias("tokens"), F.count_if(F.col("offset") != F.col("_free")).alias("holes"))
    held = boxes.agg(F.count_if(F.col("tokens") > capacity).alias("over_capacity"), F.coalesce(F.sum("holes"), F.lit(0)).alias("misplaced"))
    cut = packed.where((F.col("piece") == 1) & (F.col("n_tokens") < capacity)).join(packed.where(F.col("piece") == 2).select("doc_id"), "doc_id", "left_semi")
    whole = packed.agg(F.count_if(F.col("piece") == 1).alias("n_docs"), F.coalesce(F.sum("n_tokens"), F.lit(0)).cast("long").alias("n_tokens"))
    # shares are promised from the third window on, when the deficits of other shards are settled, until the first queue is empty
    ends = packed.groupBy("shard", "source").agg(F.max("window").alias("last")).groupBy("shard").agg(F.min("last").alias("last"))
    per = packed.groupBy("shard", "window").agg(*(F.coalesce(F.sum(F.when(F.col("source") == n, F.col("n_tokens"))), F.lit(0)).alias(f"t{i}") for i, n in enumerate(targets)))
    off = [F.abs(F.col(f"t{i}") / (window * capacity) - share) > slack + 1 / window for i, share in enumerate(targets.values())]
    bad = F.lit(False)
    for o in off:
        bad = bad | o
    windows = per.join(ends, "shard").where(F.col("window").between(2, F.col("last") - 1)).agg(F.count_if(bad).alias("off_target"))
    return whole.crossJoin(cut.agg(F.count(F.lit(1)).alias("needless_cuts"))).crossJoin(held).crossJoin(windows)
