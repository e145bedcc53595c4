"""Mixing sources to target weights by min-cost flow.

Documents are aggregated by membership pattern (the set of sources that they belong
to). Each pattern offers its words once at no cost, a second time at a higher cost and
so on, so repetition is spread as thinly as the quotas allow. A flow of least cost
routes words from patterns to source quotas; then whole documents are selected within
each pattern in a seeded order. Only pattern totals reach the driver: their number is
bounded by ``max_patterns``, which is checked.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from queryset.llm.scratch import row_hash, written

#: Mean rows of a pattern in one bucket of the seeded order. Rows are put in exact order only in the bucket of the cut and in later ones that hold a document that fits.
BUCKET_ROWS = 2_000
#: So many buckets of a pattern are filled in one round.
ROUND = 4
#: So many rows of those buckets are broadcast at most; more are shuffled with their documents.
BROADCAST_ROWS = 200_000


def targets(sizes: dict, weights: dict, max_repeats: int) -> dict:
    """Each source's share of all words by weight, at most ``max_repeats`` times its size.

    What exceeds a source's limit is shared again among the others by weight, until
    none is above.
    """
    left, open_, out = float(sum(sizes.values())), dict(weights), {}
    while open_:
        total = sum(open_.values())
        share = {s: left * w / total for s, w in open_.items()}
        full = [s for s in open_ if share[s] > max_repeats * sizes[s]]
        if not full:
            return out | share
        for s in full:
            out[s] = float(max_repeats * sizes[s])
            left -= out[s]
            del open_[s]
    return out


def min_cost_flow(supply: list[int], quota: list[int], members: list[list[int]], max_repeats: int) -> dict:
    """{(pattern, source): words} of least convex repetition cost among the largest flows.

    Pattern p offers ``supply[p]`` words at cost 0, as many again at cost 1, and so on up
    to ``max_repeats``. Nothing else costs, so a cheapest path costs what its first edge
    does, and cheapest paths never become cheaper as the flow grows. So the offers open
    in the order of cost, and each time the flow is made as large as it can be by
    blocking flows. Paths are pushed many at a time, over a graph whose size depends on
    patterns and sources only.
    """
    n, m = len(supply), len(quota)
    source, sink, graph = n + m, n + m + 1, [[] for _ in range(n + m + 2)]
    to: list[int] = []
    room: list[int] = []

    def edge(u: int, v: int, size: int) -> int:
        for a, b, r in ((u, v, size), (v, u, 0)):
            graph[a].append(len(to))
            to.append(b)
            room.append(r)
        return len(to) - 2

    offers = [edge(source, p, 0) for p in range(n)]
    routes = {(p, s): edge(p, n + s, max_repeats * supply[p]) for p in range(n) for s in members[p]}
    for s in range(m):
        edge(n + s, sink, quota[s])

    def levels() -> list[int]:
        found, front = [-1] * len(graph), [source]
        found[source] = 0
        while front and found[sink] < 0:
            ahead = []
            for u in front:
                for k in graph[u]:
                    if room[k] > 0 and found[to[k]] < 0:
                        found[to[k]] = found[u] + 1
                        ahead.append(to[k])
            front = ahead
        return found

    for _ in range(max_repeats):
        for p, k in enumerate(offers):
            room[k] += supply[p]
        while (level := levels())[sink] >= 0:
            at, path, u = [0] * len(graph), [], source
            while True:
                if u == sink:
                    amount = min(room[k] for k in path)
                    for k in path:
                        room[k] -= amount
                        room[k ^ 1] += amount
                    path, u = [], source
                while at[u] < len(graph[u]) and not (room[graph[u][at[u]]] > 0 and level[to[graph[u][at[u]]]] == level[u] + 1):
                    at[u] += 1
                if at[u] < len(graph[u]):
                    path.append(graph[u][at[u]])
                    u = to[path[-1]]
                elif path:
                    u = to[path.pop() ^ 1]
                    at[u] += 1
                else:
                    break
    return {pair: room[k ^ 1] for pair, k in routes.items() if room[k ^ 1]}


def _words(text_col: str = "text"):
    """The number of words, 0 for null."""
    return F.size(F.regexp_extract_all(F.coalesce(text_col, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))).cast("long")


def sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``doc_id, source, size, row``: size is the number of words, 0 for null; row is a hash of all columns."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).alias("source"), _words(text_col).alias("size"), row_hash(docs).alias("row"))


def _totals(rows: DataFrame, max_patterns: int) -> list:
    """Words by pattern; fails rather than gathering more than ``max_patterns`` rows."""
    found = rows.groupBy("pattern").agg(F.sum("size").alias("words"), F.count("*").alias("n")).limit(max_patterns + 1).collect()
    if len(found) > max_patterns:
        raise ValueError(f"more than {max_patterns} membership patterns; raise max_patterns or coarsen the sources")
    return sorted(found, key=lambda r: [(s is None, s or "") for s in r["pattern"] or []])


def mix(rows: DataFrame, weights=(1, 2, 3), max_repeats: int = 3, seed: int = 17, max_patterns: int = 100_000) -> tuple[DataFrame, dict, dict]:
    """Select documents so that each source's words come near its target.

    ``rows`` has ``doc_id, size, pattern`` (array of the sources that a document belongs
    to; a null element is a source of its own), and may have ``row``, a hash that tells
    rows of equal id and size apart. ``weights`` is a dict by source, or a
    sequence that repeats over the sources in code point order, null last.

    Returns the rows with ``copies`` and ``taken`` (copies times size), the targets by
    source, and the flow {(pattern, source): words}. Every document of a pattern gets the
    pattern's whole repetitions; documents get one copy more in seeded order while their
    words fit into what is left (whole buckets of the order first, then one by one from
    the bucket of the cut to the last, passing over documents that are too large). The
    choice within a pattern depends on its own rows and quota only. No document exceeds ``max_repeats`` copies. Reruns
    agree. Documents of size zero, or without a source, are kept with nothing taken; an
    empty table gives no rows; repeated rows each count.
    """
    quota, goal, routed = _planned(rows, weights, max_repeats, max_patterns)
    return _select(rows.withColumn("key", F.to_json("pattern")), quota, seed), goal, routed


def _planned(rows: DataFrame, weights, max_repeats: int, max_patterns: int = 100_000) -> tuple[DataFrame, dict, dict]:
    """``key, base, rest, buckets`` by pattern: whole repetitions, words that are left, and buckets; the targets; the flow."""
    spark = rows.sparkSession
    found = _totals(rows.where("size(pattern) > 0"), max_patterns)
    order = sorted({s for r in found for s in r["pattern"]}, key=lambda s: (s is None, s or ""))
    by_source = weights if isinstance(weights, dict) else {s: weights[k % len(weights)] for k, s in enumerate(order)}
    within = {s: sum(r["words"] for r in found if s in r["pattern"]) for s in order}
    goal = targets(within, {s: by_source[s] for s in order}, max_repeats) if order else {}
    index = {s: k for k, s in enumerate(order)}
    flow = min_cost_flow([r["words"] for r in found], [math.floor(goal[s] + 1e-6) for s in order], [[index[s] for s in r["pattern"]] for r in found], max_repeats)
    plan, sent = [], [0] * len(found)
    for (p, _), v in flow.items():
        sent[p] += v
    for total, r in zip(sent, found):
        words = max(1, r["words"])
        plan.append((list(r["pattern"]), total // words, total % words, -(-r["n"] // BUCKET_ROWS)))
    quota = spark.createDataFrame(plan, "pattern array<string>, base long, rest long, buckets long").select(F.to_json("pattern").alias("key"), "base", "rest", "buckets")
    routed = {(tuple(found[p]["pattern"]), order[s]): v for (p, s), v in flow.items()}
    return quota, goal, routed


def _select(rows: DataFrame, quota: DataFrame, seed: int) -> DataFrame:
    """Which documents get one copy more."""
    rows = _dealt(rows, quota, seed)
    cut, seen, inside = _fitted(rows)
    out = _outside(rows, cut, seen)
    out = out if inside is None else out.unionByName(inside)
    out = out.withColumn("copies", F.col("base") + F.col("more"))
    return out.withColumn("taken", F.col("copies") * F.col("size")).drop("key", "mark", "bucket", "base", "rest", "more")


def _dealt(rows: DataFrame, quota: DataFrame, seed: int) -> DataFrame:
    """The rows with their bucket and with what their pattern takes of each."""
    # A row's place depends on the row and its pattern's size alone; equal rows share a place and are interchangeable.
    quota = F.broadcast(quota)  # at most max_patterns rows
    told = ["row"] if "row" in rows.columns else []
    rows = rows.withColumn("mark", F.xxhash64(F.lit(seed), "key", F.coalesce("doc_id", F.lit(-1)), "size", *told))
    rows = rows.join(quota, "key", "left").withColumn("bucket", F.coalesce(F.pmod("mark", "buckets"), F.lit(0))).drop("buckets")
    return rows.withColumn("base", F.coalesce("base", F.lit(0).cast("long")))


def _fitted(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """Which documents get one copy more: the bucket of the cut by pattern, the buckets that were filled one by one, and their rows with ``more`` (None: no such bucket)."""
    told = ["row"] if "row" in rows.columns else []
    filled = rows.where("size > 0 AND rest > 0").groupBy("key", "bucket").agg(F.sum("size").alias("words"), F.min("size").alias("least"), F.first("rest").alias("rest"))
    filled = written(filled, "filled")
    upto = F.sum("words").over(Window.partitionBy("key").orderBy("bucket"))
    crossing = filled.withColumn("upto", upto).where("upto > rest")
    cut = written(crossing.groupBy("key").agg(F.min("bucket").alias("cut"), F.min(F.col("upto") - F.col("words")).alias("before"), F.first("rest").alias("rest")), "cut")
    names = rows.columns

    def fit(frame):
        frame = frame.sort_values(["bucket", "mark", "doc_id", "size", *told], kind="stable")
        left, more = int(frame["left"].iloc[0]), []
        for n in frame["size"]:
            more.append(int(n <= left))
            left -= n * more[-1]
        return frame.assign(more=more)[[*names, "more"]]

    kind = rows.withColumn("more", F.lit(0).cast("long")).schema
    inside, seen = None, filled.select("key", "bucket").where("false")
    state = cut.select("key", (F.col("cut") - 1).alias("at"), (F.col("rest") - F.col("before")).alias("left"))
    while True:
        # The next buckets that hold a document that fits; each round leaves less or passes them.
        rank = F.row_number().over(Window.partitionBy("key").orderBy("bucket"))
        ahead = filled.join(F.broadcast(state), "key").where("bucket > at AND least <= left").withColumn("rank", rank).where(F.col("rank") <= ROUND)
        ahead = written(ahead.select("key", "bucket", "left"), "ahead")
        if ahead.isEmpty():
            break
        fitted = rows.where("size > 0").join(F.broadcast(ahead), ["key", "bucket"]).groupBy("key").applyInPandas(fit, kind)
        fitted = written(fitted, "fitted")
        inside = fitted if inside is None else inside.unionByName(fitted)
        seen = seen.union(ahead.select("key", "bucket"))
        passed = ahead.groupBy("key").agg(F.max("bucket").alias("at"), F.first("left").alias("left"))
        took = fitted.groupBy("key").agg(F.sum(F.col("more") * F.col("size")).alias("took"))
        state = written(passed.join(took, "key").select("key", "at", (F.col("left") - F.col("took")).alias("left")), "left")
    return cut, seen, inside


def _outside(rows: DataFrame, cut: DataFrame, seen: DataFrame) -> DataFrame:
    """The other rows with ``more``, which their bucket alone tells."""
    placed = rows.join(F.broadcast(cut.select("key", "cut")), "key", "left").join(F.broadcast(seen.withColumn("seen", F.lit(True))), ["key", "bucket"], "left")
    below = (F.coalesce("rest", F.lit(0)) > 0) & (F.col("size") > 0) & (F.col("cut").isNull() | (F.col("bucket") < F.col("cut")))
    return placed.where((F.col("size") == 0) | F.col("seen").isNull()).withColumn("more", below.cast("long")).select(*rows.columns, "more")


def _chosen(docs: DataFrame, weights, max_repeats: int, seed: int) -> tuple[DataFrame, DataFrame, dict]:
    """What mix() makes of documents of one source each, their sizes, and the targets."""
    rows = written(sizes(docs), "sizes")
    chosen, goal, _ = mix(rows.withColumn("pattern", F.array("source")), weights, max_repeats, seed)
    return chosen, rows, goal


def mix_documents(docs: DataFrame, weights=(1, 2, 3), max_repeats: int = 3, seed: int = 17) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies, taken`` of every document, each of one source (null is a source).

    Null and empty texts have size 0 and nothing is taken of them; repeated rows each
    count; other columns only tell rows of equal id and size apart; an empty table gives no rows.
    """
    spark = docs.sparkSession
    chosen, rows, goal = _chosen(docs, weights, max_repeats, seed)
    per = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    goals = spark.createDataFrame([(s, t) for s, t in goal.items()], "source string, target double")
    per = per.join(goals, per["source"].eqNullSafe(goals["source"]), "left").select(per["source"], "source_size", F.coalesce("target", F.lit(0.0)).alias("target"))
    out = chosen.join(per, chosen["source"].eqNullSafe(per["source"]), "left")
    return out.select("doc_id", chosen["source"], "size", "source_size", "target", "copies", "taken")


def mixed_documents(docs: DataFrame, weights=(1, 2, 3), max_repeats: int = 3, seed: int = 17) -> DataFrame:
    """The documents that the mix takes, each row as often as the mix takes it; columns as they came.

    Rows are told apart by their id and a hash of all columns, so rows with equal or null
    ids each have their own copies, and of equal rows the copies are added up. Documents
    without words are not taken. An empty table gives no rows.
    """
    rows = written(sizes(docs), "sizes").withColumn("pattern", F.array("source")).withColumn("key", F.to_json("pattern"))
    quota, _, _ = _planned(rows, weights, max_repeats)
    cut, seen, inside = _fitted(_dealt(rows, quota, seed))
    # A row's own columns tell its bucket, so its copies need no join but in the few buckets that were filled one by one.
    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.array("source").alias("pattern"), _words().alias("size"), row_hash(docs).alias("row"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"))
    whole = _dealt(whole.withColumn("key", F.to_json("pattern")), quota, seed)
    out = [_outside(whole, cut, seen).select("doc", (F.col("base") + F.col("more")).alias("copies"))]
    if inside is not None:
        some = inside.groupBy(F.col("doc_id").alias("id"), F.col("row").alias("same")).agg(F.sum(F.col("base") + F.col("more")).alias("copies"), F.count("*").alias("rows"))
        some = written(some, "copies")
        for which in ("rows = 1", "rows > 1"):
            part = some.where(which)
            if n := part.count():
                part = F.broadcast(part) if n <= BROADCAST_ROWS else part
                found = whole.where("size > 0").join(F.broadcast(seen), ["key", "bucket"], "left_semi").join(part, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("row") == F.col("same")))
                found = found if which == "rows = 1" else found.dropDuplicates(["doc_id", "row"])
                out.append(found.select("doc", "copies"))
    taken = reduce(DataFrame.unionByName, out).where("copies > 0")
    return taken.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(*(F.col("doc")[c].alias(c) for c in docs.columns))
