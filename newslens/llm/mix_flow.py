"""Mixing sources to target weights by min-cost flow.

Copies of one text may stand in several sources. Documents are aggregated by
membership pattern (the set of sources that hold their text). A flow routes each
pattern's words to the quotas of its sources: a source can take at most
``REPEAT`` times the words that it holds, and each further use of the same
distinct words costs more, so repetition is spread before any text is used again. Then each
(pattern, source) cell takes documents in seeded order until its flow is used up.

A document's size is its number of words, runs without ASCII white space; null
texts have none. Targets: the sources share SHARE times all words by weight;
none gets more than REPEAT times its own words, the excess is reshared.
"""

from __future__ import annotations

from collections import deque

from pyspark.sql import DataFrame, Window, functions as F

from newslens.llm.common import WORD, columns_of, free, stored
from newslens.llm.exact_dedup import digest

WEIGHTS = (3, 1, 2)
SHARE = 1.5
REPEAT = 2
SEED = 20240
MAX_PATTERNS = 4096  # patterns routed by themselves
COARSE = 1024        # unions of all rarer patterns, by their first two sources
_BUCKETS = 4096


def targets(sizes: list[int], weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
            repeat: int = REPEAT) -> list[float]:
    """Words for each source, sources in order."""
    out = [0.0] * len(sizes)
    open_, rest = list(range(len(sizes))), share * sum(sizes)
    while open_:
        total = sum(weights[i % len(weights)] for i in open_)
        shares = {i: rest * weights[i % len(weights)] / total for i in open_}
        over = [i for i in open_ if shares[i] > repeat * sizes[i]]
        if not over:
            for i in open_:
                out[i] = shares[i]
            break
        for i in over:
            out[i] = float(repeat * sizes[i])
            rest -= out[i]
        open_ = [i for i in open_ if i not in set(over)]
    return out


class _Flow:
    """Maximum flow on a small network; capacities may be raised between calls."""

    def __init__(self, nodes: int):
        self.arcs: list[list[int]] = [[] for _ in range(nodes)]
        self.to: list[int] = []
        self.room: list[int] = []

    def arc(self, a: int, b: int, room: int) -> int:
        for x, y, r in ((a, b, room), (b, a, 0)):
            self.arcs[x].append(len(self.to))
            self.to.append(y)
            self.room.append(r)
        return len(self.to) - 2

    def push(self, s: int, t: int) -> int:
        total = 0
        while True:
            level = {s: 0}
            queue = deque([s])
            while queue:
                x = queue.popleft()
                for e in self.arcs[x]:
                    if self.room[e] and self.to[e] not in level:
                        level[self.to[e]] = level[x] + 1
                        queue.append(self.to[e])
            if t not in level:
                return total
            at = [0] * len(self.arcs)
            while True:  # blocking flow: one path at a time, dead ends are not tried again
                path, x = [], s
                while x != t:
                    while at[x] < len(self.arcs[x]):
                        e = self.arcs[x][at[x]]
                        if self.room[e] and level.get(self.to[e], -1) == level[x] + 1:
                            break
                        at[x] += 1
                    else:
                        if not path:
                            break
                        x = self.to[path.pop() ^ 1]
                        at[x] += 1
                        continue
                    path.append(e)
                    x = self.to[e]
                if x != t:
                    break
                low = min(self.room[e] for e in path)
                total += low
                for e in path:
                    self.room[e] -= low
                    self.room[e ^ 1] += low


def route(cells: list[tuple], distinct: dict, quotas: dict, repeat: int = REPEAT) -> dict:
    """Words from each cell (pattern, source) by a minimum-cost flow.

    cells: (pattern, source, words); distinct: pattern -> words of its distinct
    texts. Each further use of a pattern's distinct words costs more, by the
    number of uses alone, so the flow is sent use by use: first all that fits
    into the first use of every pattern, then into the second, and so on. A
    pattern that cannot fill a use is blocked for good, for later flow never
    opens a way again. Uses that all open patterns fill are taken in one step,
    whose length a binary search finds; so the number of maximum flows grows with the
    number of blocking moments, one per source at most, and not with the uses.
    """
    patterns = sorted({p for p, _, _ in cells})
    sources = sorted(quotas)
    node = {("p", p): i + 2 for i, p in enumerate(patterns)}
    node |= {("s", s): i + 2 + len(patterns) for i, s in enumerate(sources)}
    flow = _Flow(2 + len(node))
    supply = {p: flow.arc(0, node["p", p], 0) for p in patterns}
    inner = {}
    most: dict = {}
    for p, s, words in cells:
        inner[p, s] = flow.arc(node["p", p], node["s", s], repeat * words)
        most[p] = most.get(p, 0) + repeat * words
    for s in sources:
        flow.arc(node["s", s], 1, quotas[s])
    given = dict.fromkeys(patterns, 0)
    open_ = [p for p in patterns if most[p] and distinct[p]]
    need, uses = sum(quotas.values()), 0

    def send(level: int) -> tuple[int, int]:
        """Open all uses up to ``level``; words offered anew and words sent."""
        offered = 0
        for p in open_:
            more = min(level * distinct[p], most[p]) - given[p]
            flow.room[supply[p]] += more
            given[p] += more
            offered += more
        return offered, flow.push(0, 1)

    def fills(level: int) -> bool:
        room, before = flow.room.copy(), given.copy()
        offered, sent = send(level)
        flow.room[:] = room
        given.update(before)
        return offered == sent

    while need > 0 and open_:
        low, high, step = uses, max(-(-most[p] // distinct[p]) for p in open_), 1
        while low + step < high and fills(low + step):
            low, step = low + step, 2 * step
        high = min(high, low + step)
        while low < high:
            mid = (low + high + 1) // 2
            low, high = (mid, high) if fills(mid) else (low, mid - 1)
        need -= send(low)[1]
        open_ = [p for p in open_ if given[p] < most[p]]
        uses = low + 1
        need -= send(uses)[1]
        for p in open_:
            if flow.room[supply[p]]:  # blocked
                flow.room[supply[p]] = 0
                most[p] = given[p]
        open_ = [p for p in open_ if given[p] < most[p]]
    return {k: flow.room[e ^ 1] for k, e in inner.items()}


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, repeat: int = REPEAT,
        seed: int = SEED, max_patterns: int = MAX_PATTERNS) -> DataFrame:
    """(doc_id, source, digest, size, source_size, target, taken) for every row of ``docs``.

    The driver sees one number per source and per joint cell: of the ``max_patterns`` patterns with most words, and
    of at most ``COARSE`` unions of all others, which keep one supply for all their texts.
    """
    spark = docs.sparkSession
    words = stored(docs.select(
        "doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        digest(F.col("text")).alias("digest")), "sizes")
    names = words.groupBy("source").agg(F.sum("size").alias("n")).collect()
    names.sort(key=lambda r: (r["source"] is None, (r["source"] or "").encode()))
    aims = targets([r["n"] for r in names], weights, share, repeat)
    listed = spark.createDataFrame(
        [(i, r["source"], r["n"], t) for i, (r, t) in enumerate(zip(names, aims))],
        "no int, source string, source_size long, target double")
    numbered = words.join(F.broadcast(listed.select("no", F.col("source").alias("_s"))),
                          words["source"].eqNullSafe(F.col("_s"))).drop("_s")

    # texts in one source only need no list; of the others the set of sources is the pattern
    text = numbered.groupBy("digest").agg(F.max("size").alias("once"), F.sort_array(F.collect_set("no")).alias("in"))
    joint = text.where(F.size("in") > 1).groupBy("in").agg(F.sum("once").alias("once"))
    chosen = stored(joint.orderBy(F.desc("once"), "in").limit(max_patterns).withColumn(
        "pattern", F.row_number().over(Window.orderBy(F.desc("once"), "in"))), "patterns")
    union = F.pmod(F.hash(F.get("in", F.lit(0)), F.get("in", F.lit(1))), F.lit(COARSE)) + max_patterns + 1
    shared = stored(text.where(F.size("in") > 1).join(F.broadcast(chosen.select("in", "pattern")), "in", "left").select(
        "digest", F.coalesce("pattern", union).alias("pattern"), "once"), "shared-texts")
    # pattern -1 - no: words that only their own source uses
    marked = stored(numbered.join(shared.drop("once"), "digest", "left").withColumn(
        "pattern", F.coalesce("pattern", -1 - F.col("no"))).withColumn(
        "u", F.xxhash64(F.lit(seed), "doc_id")), "marked-sizes")

    cells = sorted((r["pattern"], r["no"], r["n"]) for r in  # the flow depends on their order
                   marked.groupBy("pattern", "no").agg(F.sum("size").alias("n")).collect())
    distinct = {r["pattern"]: r["n"] for r in shared.groupBy("pattern").agg(F.sum("once").alias("n")).collect()}
    distinct |= {p: n for p, _, n in cells if p < 0}
    flow = route(cells, distinct, {i: int(t) for i, t in enumerate(aims)}, repeat)
    quotas = spark.createDataFrame(
        [(p, s, f // n if n else 0, f % n if n else 0) for (p, s, n) in cells for f in [flow[p, s]]],
        "pattern int, no int, passes long, more long")

    # seeded order in two steps, as a cell may hold a third of all rows: whole buckets, then inside each
    bucket = F.pmod("u", F.lit(_BUCKETS)).cast("int")
    filled = marked.withColumn("bucket", bucket)
    sums = filled.groupBy("pattern", "no", "bucket").agg(F.sum("size").alias("n"))
    ahead = Window.partitionBy("pattern", "no").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select("pattern", "no", "bucket", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("before"))
    inside = Window.partitionBy("pattern", "no", "bucket").orderBy("u", "doc_id", "size", "digest").rowsBetween(
        Window.unboundedPreceding, -1)
    placed = filled.withColumn("ahead", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(
        before, ["pattern", "no", "bucket"])
    extra = F.least("size", F.greatest(F.lit(0), F.col("more") - F.col("before") - F.col("ahead")))
    return placed.join(F.broadcast(quotas), ["pattern", "no"]).join(F.broadcast(listed.drop("source")), "no").select(
        "doc_id", "source", "digest", "size", "source_size", "target",
        (F.col("passes") * F.col("size") + extra).alias("taken"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """``docs`` as the mix uses them: each row as often as it is taken, a part rounded up.

    Rows of which nothing is taken go. Rows alike in doc_id, source and text are
    interchangeable, so their uses are counted together.
    """
    key, n, i = free(docs, "_digest", "_n", "_i")
    uses = mix(docs, **options).groupBy("doc_id", "source", "digest").agg(
        F.sum(F.when(F.col("size") > 0, F.ceil(F.col("taken") / F.col("size"))).otherwise(0)).alias("uses"),
        F.count("*").alias("rows")).where("uses > 0")
    left = docs.withColumn(key, digest(F.col("text"))).alias("l")
    same = (F.col(f"l.{key}") == F.col("r.digest")) & F.col("l.doc_id").eqNullSafe(F.col("r.doc_id")) \
        & F.col("l.source").eqNullSafe(F.col("r.source"))
    joined = left.join(uses.alias("r"), same).select(
        *[F.col(f"l.`{c}`") for c in docs.columns], F.ceil(F.col("r.uses") / F.col("r.rows")).cast("int").alias(n))
    return joined.withColumn(i, F.explode(F.sequence(F.lit(1), F.col(n)))).select(*columns_of(docs))
