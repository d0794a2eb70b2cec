r"""N-gram Jaccard join by a token-group matrix.

Words are ``[^\x20\x09-\x0D]+`` after lower-casing A-Z; a document's set holds its
distinct five-word shingles (with fewer words, the whole sequence as one).
Documents link when 100 * |A & B| >= 75 * |A | B|; the result is the component
of each document.

1. Equal sets are one node.  One map-only pass computes each row's node, set
   size and eight min-hash bands.
2. Partition: nodes that share a band meet at its smallest set, and the texts
   of such star edges are compared exactly.  The components of true links are
   the groups.  This step need not find every link.
3. Matrix and bound: a group's token union is the set of (token, group) rows.
   A node can link to another group only if enough of its tokens lie in the
   union of other groups.  The test runs first on a prefix of the tokens (30 %
   by hash; any two linked sets share a stated number of tokens of their
   prefixes), then on all tokens of the nodes left, twice.
4. Open: for the nodes still left, tokens are ordered by the number of nodes
   that have them; nodes and groups meet in the lists of their prefixes' rare
   tokens.  There the token union of a group's members is a bitmap, which
   bounds a node's overlap with it from above; the group is opened only where
   that suffices for its smallest member, its members are bounded one by one
   in the same way, and what is left is compared exactly by whole token sets.
   A list is the place of the first token that a linked pair shares, so its
   bitmaps hold only what follows in each set: lists of later shared tokens
   reject pairs near the threshold instead of naming them again.  Sets over
   CLASS tokens are cut into classes by token hash; as intersections and
   unions add up over classes, a linked pair reaches 0.75 in one class at
   least, and bitmaps of classes bound long sets as sharply as short ones.
   Rounds in which each node of a list gives only its nearest partner come
   first; their links join groups, and nodes that the bound of 3 then rejects
   go.  The last round gives all pairs between the groups that remain.

No step is approximate: every link is either inside a group or found in 4,
which makes the components exact.  Steps 3 and 4 compare a node with groups,
and 4 joins near copies that the bands left apart before it lists pairs, so
thousands of near copies are never written pairwise.

Scale: texts are shuffled only for star edges (a member's text once; a hot
pivot is repeated for every STAR members).  For the bound a batch sends its
tokens as sorted hashes, cut into ranges of the hash, with the place of each
one's node; of a token that two groups of the batch have only two nodes meet
the other batches.  The number of ranges grows with the tokens, so that a range
holds about RANGE of them.  A token's list is cut
into chunks of LIST nodes, two of which are compared by a task; pairs that the
bounds reject are never written.  Nothing is collected but counts; labels are broadcast only up to MAX_BROADCAST counted rows.
Tokens and nodes are 64-bit hashes.

Defined cases: null, empty or blank texts have an empty set and stay alone
(n_shingles 0, component_id their own doc_id, null for a null doc_id); rows
with one set are linked whatever their doc_ids; empty tables give empty
results; only doc_id and text are read.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from . import _text as X
from ._components import components
from ._stage import free_name, stage

SIZE = 5
PERCENT = 75
BANDS, ROWS = 8, 3
#: members of one pivot that are compared by one task group
STAR = 2000
#: bytes of texts that a worker turns into sets at once (a longer text alone)
TEXT_BYTES = 1 << 19
#: (node, label) rows of 16 bytes that may be broadcast
MAX_BROADCAST = 400_000
#: tokens of a range of hashes that one task compares at once
RANGE = 1 << 20
#: bits of a bitmap, and tokens of a class of a set that one bitmap stands for
BITS, CLASS = 1024, 512
#: nodes of one list that are compared at once (longer lists are compared chunk by chunk), and list rows of one Arrow batch
LIST, ROWS_OUT = 2000, 1 << 14
#: rounds of nearest partners end when one gives no more links than one for so many nodes
JOINED = 20
_SEEDS = np.random.default_rng(5).integers(1, 2**63, (2, BANDS * ROWS), dtype=np.uint64) | np.uint64(1)


def token_sets(raw: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each document of a block."""
    raw = X.LOWER[raw]
    starts, ends, doc = X.span_words(raw, offsets, X.SPACED)
    words = X.span_hash(X.prefix_hash(raw), starts, ends)
    grams = X.sliding_hash(words, SIZE)
    bounds = np.searchsorted(doc, np.arange(len(offsets)))
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        n = b - a
        if n >= SIZE:
            out.append(np.unique(grams[a : b - SIZE + 1]))
        else:
            out.append(X.sliding_hash(words[a:b], n) + np.uint64(n) if n else np.zeros(0, np.uint64))
    return out


def node_of(tokens: np.ndarray) -> int:
    """64-bit hash of a set, as a signed long."""
    h = X.mix(np.array([X.mix(tokens ^ np.uint64(0xA5A5)).sum() + np.uint64(len(tokens))], np.uint64))
    return int(h.view(np.int64)[0])


def _bands(tokens: np.ndarray) -> list[int]:
    low = np.empty(BANDS * ROWS, np.uint64)
    for j in range(BANDS * ROWS):
        low[j] = ((tokens ^ _SEEDS[0, j]) * _SEEDS[1, j]).min()
    keys = X.mix(low.reshape(BANDS, ROWS) + np.arange(ROWS, dtype=np.uint64) * np.uint64(7))
    return X.mix(keys.sum(axis=1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64)).view(np.int64).tolist()


def least_overlap(n: int) -> int:
    """Tokens that a set of n shares at least with any set it links to."""
    return -(-PERCENT * n // 100)


def prefix_length(n: int) -> int:
    """Length of the hash-ordered prefix: linked sets share ``prefix_need`` tokens of theirs."""
    return min(n, n - least_overlap(n) + max(1, n // 20))


def prefix_need(n: int) -> int:
    """The partner may be a quarter smaller, and its prefix extension with it."""
    return max(1, least_overlap(n) // 20)


def _lists(sets: list[np.ndarray]) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(c) for c in sets])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*sets, np.zeros(0, np.uint64)]).view(np.int64)))


def _profile(docs: DataFrame) -> DataFrame:
    """(row, doc_id, n, node, bands, tokens): tokens are the prefix by hash, written here so that the bound needs no second look at the texts."""
    fields = T.StructType([T.StructField("n", T.LongType()), T.StructField("node", T.LongType()), T.StructField("bands", T.ArrayType(T.LongType())),
                           T.StructField("tokens", T.ArrayType(T.LongType()))])

    def make():
        def run(raw, offsets):
            sets = token_sets(raw, offsets)
            return [[len(s) for s in sets], [node_of(s) for s in sets], [_bands(s) if len(s) else [] for s in sets], _lists([s[: prefix_length(len(s))] for s in sets])]

        return run

    return X.map_text(docs, "text", ["row", "doc_id"], fields, "p", make, TEXT_BYTES).select("row", "doc_id", "p.*")


def keyed_rows(docs: DataFrame, columns: list[str]) -> DataFrame:
    """The rows written once with a number of their own in ``row``: doc_ids may be null or repeated, so they identify nothing."""
    return stage(docs.select(*[F.col(f"`{c}`") for c in columns], F.monotonically_increasing_id().alias("row")), "rows")


def _tokens(docs: DataFrame) -> DataFrame:
    """(node, n, tokens) of every row with words."""
    fields = T.StructType([T.StructField("node", T.LongType()), T.StructField("n", T.LongType()), T.StructField("tokens", T.ArrayType(T.LongType()))])

    def make():
        def run(raw, offsets):
            sets = token_sets(raw, offsets)
            return [[node_of(s) for s in sets], [len(s) for s in sets], _lists(sets)]

        return run

    return X.map_text(docs, "text", [], fields, "t", make, TEXT_BYTES).select("t.*").filter("n > 0")


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= MAX_BROADCAST else df


def _texts(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, text), one row a node; ``nodes`` has node and rep, the number of one row of it."""
    return docs.select("row", "text").join(_small(nodes.select("node", "rep")), F.col("row") == F.col("rep")).select("node", "text")


def _star_links(docs: DataFrame, reps: DataFrame, edges: DataFrame) -> DataFrame:
    """(a, b) of the edges (member, pivot) whose sets link; the texts are compared exactly.

    Rows are sorted by pivot and salt, the pivot's text first, and stream
    through the task: memory holds one pivot's set at a time.
    """
    counts = edges.groupBy("pivot").agg(F.count(F.lit(1)).alias("n")).select("pivot", F.expr(f"cast(ceil(n / {STAR}) as int)").alias("salts"))
    counts = stage(counts, "pivots")
    salted = stage(edges.join(counts, "pivot").select("member", "pivot", F.expr("cast(pmod(xxhash64(member), salts) as int)").alias("salt")), "stars")
    heads = counts.select(F.col("pivot").alias("member"), "pivot", F.explode(F.expr("sequence(0, salts - 1)")).alias("salt"))
    wanted = salted.unionByName(heads)
    nodes = wanted.select(F.col("member").alias("node")).distinct().join(reps, "node")
    texts = _texts(docs, stage(nodes, "wanted")).withColumnRenamed("node", "member")
    rows = texts.join(wanted, "member").select("pivot", "salt", (F.col("member") != F.col("pivot")).cast("int").alias("rest"), "member", "text")
    rows = rows.repartition("pivot", "salt").sortWithinPartitions("pivot", "salt", "rest", "member")

    def run(batches):
        head, own = None, None
        for batch in batches:
            key = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True))
            a, b, at = [], [], 0
            for raw, offsets in X.blocks(batch.column(4), TEXT_BYTES):
                for tokens in token_sets(raw, offsets):
                    pivot, salt, rest, member = key[at]
                    at += 1
                    if not rest:
                        head, own = (pivot, salt), tokens
                    elif head == (pivot, salt):
                        both = len(np.intersect1d(own, tokens, assume_unique=True))
                        if 100 * both >= PERCENT * (len(own) + len(tokens) - both):
                            a.append(member), b.append(pivot)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return rows.mapInArrow(run, "a long, b long").distinct()


def _groups(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, label) of nodes in star components of more than one node."""
    keys = nodes.select("node", "n", F.explode("bands").alias("band"))
    # the smallest set of a band is the pivot: of documents around one passage, the one with least besides links to most
    pivots = keys.groupBy("band").agg(F.min(F.struct("n", "node")).alias("p"), F.min("node").alias("lo"), F.max("node").alias("hi")).filter("lo < hi")
    pivots = stage(pivots.select("band", F.col("p.node").alias("pivot"), F.col("p.n").alias("size")), "bands")
    edges = keys.join(pivots, "band").filter("node <> pivot").groupBy(F.col("node").alias("member"), "pivot", "size").agg(F.count(F.lit(1)).alias("shared"))
    edges = stage(edges.join(nodes.select(F.col("node").alias("member"), "n"), "member").filter(f"100 * least(n, size) >= {PERCENT} * greatest(n, size)"), "meet")
    reps = nodes.select("node", "rep")
    first = edges.groupBy("member").agg(F.max(F.struct("shared", (-F.col("size")).alias("low"), "pivot")).alias("x")).select("member", "x.pivot")
    links = stage(_star_links(docs, reps, first), "links")
    labels = components(links)
    # what is left between different groups
    a, b = (labels.select(F.col("node").alias(x), F.col("label").alias(f"l{x}")) for x in ("member", "pivot"))
    rest = edges.join(a, "member", "left").join(b, "pivot", "left").select("member", "pivot", F.coalesce("lmember", "member").alias("g"), F.coalesce("lpivot", "pivot").alias("h"))
    rest = rest.join(first.withColumn("seen", F.lit(True)), ["member", "pivot"], "left").filter("g <> h and seen is null").select("member", "pivot")
    more = stage(_star_links(docs, reps, stage(rest, "rest")), "links")
    return components(links.unionByName(more)) if more.limit(1).count() else labels


def _crossing(rows: DataFrame, sizes: DataFrame, need) -> DataFrame:
    """Nodes of ``rows`` (node, label, n, tokens) with at least need(n) tokens in the unions of other groups; ``sizes`` has their node and n.

    A batch sends each range of the hash its tokens there, as steps from one to
    the next, and their nodes.  A token that two groups of the batch have is
    settled for all its nodes: one node of its first and of its last group
    meets the other batches, the rest travel on their own.
    """
    tokens = rows.agg(F.sum(F.size("tokens"))).first()[0] or 0
    parts = max(1, -(-tokens // RANGE))
    bounds = np.array([i * (1 << 64) // parts for i in range(parts)], np.uint64)

    def cell(part: int, settled: bool, keys: np.ndarray, start, place: np.ndarray, nodes: np.ndarray, labels: np.ndarray) -> tuple:
        some, place = np.unique(place, return_inverse=True)
        nodes, labels = nodes[some], labels[some]
        steps = np.diff(nodes.view(np.uint64), prepend=np.uint64(0))
        return part, settled, len(keys), len(nodes), X.packed(np.diff(keys, prepend=start)), X.packed(place.astype(np.uint32)), X.packed(steps), X.packed(labels ^ nodes)

    def run(batches):
        turn = TaskContext.get().partitionId()
        for batch in batches:
            lists = batch.column(2)
            flat = lists.flatten().to_numpy().view(np.uint64)
            if not len(flat):
                continue
            # rows of equal sets say the same
            nodes, at = np.unique(batch.column(0).to_numpy(), return_index=True)
            labels = batch.column(1).to_numpy()[at]
            rank = np.full(batch.num_rows, -1)
            rank[at] = np.arange(len(at))
            place = np.repeat(rank, np.diff(lists.offsets.to_numpy()))
            flat, place = flat[place >= 0], place[place >= 0]
            order = np.lexsort((labels[place], flat))
            keys, place = flat[order], place[order]
            first = np.concatenate([[True], keys[1:] != keys[:-1]])
            last = np.append(first[1:], True)
            begin, end = np.flatnonzero(first), np.flatnonzero(last)
            crossed = labels[place[begin]] != labels[place[end]]
            inner = np.repeat(crossed, end - begin + 1) & ~first & ~last
            out = []
            if inner.any():
                out.append(cell(turn % parts, True, keys[inner], np.uint64(0), place[inner], nodes, labels))  # needs no range of its own
                keys, place = keys[~inner], place[~inner]
            edges = np.append(np.searchsorted(keys, bounds), len(keys)).tolist()
            for p in range(parts):
                if edges[p] < edges[p + 1]:
                    c = slice(edges[p], edges[p + 1])
                    out.append(cell(p, False, keys[c], bounds[p], place[c], nodes, labels))
            turn += 1
            kinds = (pa.int32(), pa.bool_(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*out, strict=True), kinds, strict=True)],
                                             ["part", "settled", "n", "m", "keys", "place", "nodes", "labels"])

    def shared(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        told, met = [], []
        for settled, n, m, *data in zip(*(table.column(c).to_pylist() for c in ("settled", "n", "m")), *(table.column(c) for c in ("keys", "place", "nodes", "labels")), strict=True):
            data = [X.unpacked(x.as_buffer(), k, kind) for x, k, kind in zip(data, (n, n, m, m), (np.uint64, np.uint32, np.uint64, np.int64), strict=True)]
            keys = (np.uint64(0) if settled else bounds[part]) + np.cumsum(data[0], dtype=np.uint64)
            nodes = np.cumsum(data[2], dtype=np.uint64).view(np.int64)
            if settled:
                told.append((nodes[data[1]], keys))
            else:
                met.append((nodes[data[1]], keys, (data[3] ^ nodes)[data[1]]))
        if met:
            node, keys, label = (np.concatenate(x) for x in zip(*met, strict=True))
            met.clear()
            order = np.argsort(keys)
            node, keys, label = node[order], keys[order], label[order]
            begin = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            crossed = np.repeat(np.minimum.reduceat(label, begin) != np.maximum.reduceat(label, begin), np.diff(np.append(begin, len(keys))))
            told.append((node[crossed], keys[crossed]))
        node, keys = (np.concatenate(x) for x in zip(*told, strict=True))
        return pa.table([pa.array(node), pa.array(keys.view(np.int64))], ["node", "token"])

    sent = rows.select("node", "label", "tokens").mapInArrow(run, "part int, settled boolean, n int, m int, keys binary, place binary, nodes binary, labels binary")
    # several batches may say a node's token by way of equal sets, which are one node
    found = sent.groupBy("part").applyInArrow(shared, "node long, token long").groupBy("node").agg(F.countDistinct("token").alias("found"))
    return found.join(sizes, "node").filter(need).select("node")


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """(node, label) with the groups joined that ``links`` (a, b) connect; nodes without a row are groups of their own."""
    a, b = (labels.select(F.col("node").alias(x), F.col("label").alias(f"l{x}")) for x in "ab")
    top = links.join(a, "a", "left").join(b, "b", "left").select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b"))
    over = components(top).withColumnRenamed("node", "old").withColumnRenamed("label", "new")
    known = labels.select("node", "label")
    for x in "ab":
        known = known.unionByName(top.select(F.col(x).alias("node"), F.col(x).alias("label")))
    known = known.groupBy("node").agg(F.min("label").alias("label"))
    return stage(known.join(over, known["label"] == over["old"], "left").select("node", F.coalesce("new", "label").alias("label")), "labels")


def component_table(docs: DataFrame) -> DataFrame:
    """(row, doc_id, n, node, label) of every row of :func:`keyed_rows`; label is null for rows without a set."""
    rows = stage(_profile(docs), "profile")
    nodes = stage(rows.filter("n > 0").groupBy("node").agg(F.min("row").alias("rep"), F.first("bands").alias("bands"), F.first("n").alias("n")), "nodes")
    labels = _groups(docs, nodes)

    def labelled(t: DataFrame) -> DataFrame:
        """With the groups known so far."""
        return t.join(_small(labels), "node", "left").select("node", "n", "tokens", F.coalesce("label", "node").alias("label"))

    sizes = nodes.select("node", "n")
    # bounds: prefix by hash, then all tokens, among the nodes still left
    need = f"found >= greatest(1, floor(floor(({PERCENT} * n + 99) / 100) / 20))"
    full = f"100 * found >= {PERCENT} * n"
    left = stage(_crossing(labelled(rows.select("node", "n", "tokens").filter("n > 0")), sizes, need), "left")
    reps = nodes.select("node", "rep")
    some = _texts(docs, stage(reps.join(left, "node"), "reps"))
    sets = stage(labelled(_tokens(some).join(_small(left), "node", "left_semi")).dropDuplicates(["node"]), "sets")
    while True:
        for _ in range(2):
            left = stage(_crossing(sets, sizes, full), "left")
            sets = sets.join(_small(left), "node", "left_semi")
        sets = stage(sets, "open")
        links = _open(sets, True)
        found, held = links.count(), sets.count()
        if found:
            labels = _merged(labels, links)
            sets = labelled(sets.drop("label"))
        if found * JOINED <= held:  # the rounds join little more
            break
    links = _open(sets, False)
    if links.limit(1).count():
        labels = _merged(labels, links)
    return rows.join(labels, "node", "left").select("row", "doc_id", "n", "node", F.when(F.col("n") > 0, F.coalesce("label", "node")).alias("label"))


def classes_of(n: int) -> int:
    """Token classes of a set of n, a power of two: no class has much more than CLASS tokens."""
    return 1 << max(0, -(-n // CLASS) - 1).bit_length()


def _class_rows(n: int, ordered: np.ndarray, shared: np.ndarray) -> list[tuple]:
    """(tokens, classes, class size, rest, bitmaps) of each class of a set, one entry a token of the class's prefix.

    ``ordered`` holds the set's tokens by rarity, ``shared`` whether another
    group has them.  A set also takes part with the classes of the smallest
    partner it can link to, so linked sets always meet with equal classes.
    Rest and bitmap belong to the tokens from that place on which other groups
    have; earlier ones are bounded by the list in which they are the place.
    """
    out = []
    for m in sorted({classes_of(n), classes_of(least_overlap(n))}):
        kind = (ordered.view(np.uint64) >> np.uint64(40)) & np.uint64(m - 1)
        for k in range(m):
            mine = kind == k
            size = int(mine.sum())
            t = ordered[mine & shared]
            length = len(t) - least_overlap(size) + 1
            if not size or length <= 0:
                continue
            at = t & (BITS - 1)
            flags = np.zeros((length, BITS), bool)
            flags[length - 1, at[length - 1 :]] = True
            flags[np.arange(length - 1), at[: length - 1]] = True
            bits = np.packbits(np.logical_or.accumulate(flags[::-1])[::-1], axis=1)
            out.append((t[:length], m, size, len(t) - np.arange(length), bits))
    return out


def _prefixes(ordered: DataFrame) -> DataFrame:
    """Rows of the lists: one for each prefix token of each class of the sets ``ordered`` (node, n, label, t: (df, token) by rarity)."""

    def run(batches):
        for batch in batches:
            lists = batch.column(3)
            flat = lists.flatten()
            df, tokens = flat.field(0).to_numpy(), flat.field(1).to_numpy()
            ends = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            held, rows = [], 0

            def out():
                columns = [np.concatenate(c) for c in zip(*held, strict=True)]
                bits = pa.FixedSizeBinaryArray.from_buffers(pa.binary(BITS // 8), len(columns[0]), [None, pa.py_buffer(np.ascontiguousarray(columns[-1]))])
                return pa.RecordBatch.from_arrays([*map(pa.array, columns[:-1]), bits.cast(pa.binary())], ["token", "classes", "node", "n", "size", "rest", "home", "label", "bits"])

            for i, (node, n, label) in enumerate(zip(*(batch.column(j).to_pylist() for j in range(3)), strict=True)):
                lo, hi = ends[i], ends[i + 1]
                for t, m, size, rest, bits in _class_rows(n, tokens[lo:hi], df[lo:hi] > 0):
                    full = lambda value, kind=np.int64: np.full(len(t), value, kind)  # noqa: B023, E731
                    held.append((t, full(m), full(node), full(n), full(size), rest, full(m == classes_of(n), bool), full(label), bits))
                    rows += len(t)
                    if rows >= ROWS_OUT:
                        yield out()
                        held, rows = [], 0
            if held:
                yield out()

    return ordered.mapInArrow(run, "token long, classes long, node long, n long, size long, rest long, home boolean, label long, bits binary")


def opened_pairs(node: np.ndarray, n: np.ndarray, size: np.ndarray, rest: np.ndarray, home: np.ndarray, label: np.ndarray, chunk: np.ndarray, bits: np.ndarray,
                 cross: bool, nearest: bool = False) -> tuple[list, list]:
    """Pairs of one list's nodes that the bounds leave; of two chunks (``cross``) only pairs between them.

    ``nearest``: of a node's partners only the one with the most similar bitmap.

    The list stands for the first token that two linked sets share in a class,
    so all they share in it lies in the rests.  Tokens of a node's rest whose
    bits the group's union lacks are missing from every member, which bounds
    the overlap; a group is opened only where that suffices for its smallest
    member.  In an opened group each differing bit of two bitmaps stands for a
    token that only one of both rests has.  ``home``: the classes are those of
    the node's own size, as they are of the smaller of two sets.
    """
    order = np.argsort(label, kind="stable")
    node, n, size, rest, home, label, chunk, bits = (c[order] for c in (node, n, size, rest, home, label, chunk, bits))
    begin = np.flatnonzero(np.concatenate([[True], label[1:] != label[:-1]]))
    least = -(-PERCENT * size // 100)
    a, b = [], []
    top, partner = np.full(len(n), -1.0), np.zeros(len(n), np.int64)
    for lo, hi in zip(begin.tolist(), np.append(begin[1:], len(label)).tolist(), strict=True):
        if hi == len(label):
            break  # each two groups meet once
        union = np.bitwise_or.reduce(bits[lo:hi], axis=0)
        overlap = rest[hi:] - np.bitwise_count(bits[hi:] & ~union).sum(axis=1, dtype=np.int64)
        ask = hi + np.flatnonzero((100 + PERCENT) * overlap >= PERCENT * (size[hi:] + np.maximum(least[hi:], size[lo:hi].min())))
        step = max(1, (1 << 16) // (hi - lo))
        for at in range(0, len(ask), step):
            q = ask[at : at + step]
            both = size[q][:, None] + size[lo:hi][None, :]
            differ = np.bitwise_count(bits[q][:, None, :] ^ bits[lo:hi][None, :, :]).sum(axis=2, dtype=np.int64)
            twice = np.minimum(rest[q][:, None] + rest[lo:hi][None, :] - differ, 2 * np.minimum(rest[q][:, None], rest[lo:hi][None, :]))
            ok = (100 + PERCENT) * twice >= 2 * PERCENT * both
            ok &= 100 * np.minimum(n[q][:, None], n[lo:hi][None, :]) >= PERCENT * np.maximum(n[q][:, None], n[lo:hi][None, :])
            ok &= home[q][:, None] | home[lo:hi][None, :]
            if cross:
                ok &= chunk[q][:, None] != chunk[lo:hi][None, :]
            if nearest and ok.any():
                alike = np.where(ok, twice / (2 * both - twice), -1.0)
                for mine, theirs, at_best in ((q, np.arange(lo, hi), alike), (np.arange(lo, hi), q, alike.T)):
                    best = at_best.argmax(axis=1)
                    value = at_best[np.arange(len(mine)), best]
                    better = value > top[mine]
                    top[mine[better]], partner[mine[better]] = value[better], theirs[best[better]]
            elif not nearest:
                x, y = np.nonzero(ok)
                a.append(node[q[x]])
                b.append(node[lo + y])
    if nearest:
        some = np.flatnonzero(top >= 0)
        return [node[some]], [node[partner[some]]]
    return a, b


def _met(batches, nearest: bool):
    """Rows sorted by (token, classes, x, y) as pairs (a, b); memory holds one batch and one list of at most about 2 * LIST rows."""
    held = None
    for batch in itertools.chain(batches, [None]):
        if batch is not None:
            rows = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(11)]
            rows.append(np.frombuffer(b"".join(batch.column(11).to_pylist()), np.uint64).reshape(-1, BITS // 64))
            held = rows if held is None else [np.concatenate(pair) for pair in zip(held, rows, strict=True)]
        if held is None or not len(held[0]):
            continue
        keys, x, y = held[:4], held[2], held[3]
        changed = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
        begin = np.flatnonzero(np.concatenate([[True], changed]))
        ends = np.append(begin[1:], len(x))
        done = len(begin) - (batch is not None)  # the last list may go on in the next batch
        a, b = [], []
        for lo, hi in zip(begin[:done].tolist(), ends[:done].tolist(), strict=True):
            more = opened_pairs(*(c[lo:hi] for c in held[4:]), cross=bool(x[lo] != y[lo]), nearest=nearest)
            a += more[0]
            b += more[1]
        held = [c[begin[done] :] for c in held] if done < len(begin) else None
        if a:
            a, b = np.concatenate(a), np.concatenate(b)
            pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["a", "b"])


def _open(sets: DataFrame, nearest: bool) -> DataFrame:
    """(a, b): links between nodes of different groups, by the token-group matrix over ``sets`` (node, n, tokens, label).

    ``nearest``: only those among the nearest partners, at most one a node and list.
    """
    cells = sets.select("node", "label", F.explode("tokens").alias("token"))
    # by rarity; tokens of one group only come first and match nothing
    rarity = cells.groupBy("token").agg(F.count(F.lit(1)).alias("df"), F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo <> hi").select("token", "df")
    ordered = cells.select("node", "token").join(rarity, "token", "left").groupBy("node").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "token"))).alias("t"))
    prefix = stage(_prefixes(ordered.join(sets.select("node", "n", "label"), "node").select("node", "n", "label", "t")), "prefix")
    lists = prefix.groupBy("token", "classes").agg(F.count(F.lit(1)).alias("df"), F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo <> hi")
    lists = lists.select("token", "classes", F.expr(f"cast(ceil(df / {LIST}) as int)").alias("chunks"))
    rows = prefix.join(lists, ["token", "classes"]).withColumn("chunk", F.expr("cast(pmod(xxhash64(node), chunks) as int)"))
    rows = rows.withColumn("other", F.explode(F.expr("sequence(0, chunks - 1)")))
    rows = rows.select("token", "classes", F.least("chunk", "other").alias("x"), F.greatest("chunk", "other").alias("y"), "node", "n", "size", "rest", "home", "label", "chunk", "bits")
    key = ["token", "classes", "x", "y"]
    pairs = rows.repartition(*key).sortWithinPartitions(*key).mapInArrow(lambda batches: _met(batches, nearest), "a long, b long").distinct()
    left, right = (sets.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("tokens").alias(f"t{x}")) for x in "ab")
    both = stage(pairs, "opened").join(left, "a").join(right, "b")
    return stage(both.filter(f"{100 + PERCENT} * size(array_intersect(ta, tb)) >= {PERCENT} * (na + nb)").select("a", "b"), "found")


def jaccard_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of every row."""
    rows = component_table(keyed_rows(docs, ["doc_id", "text"]))
    least = rows.filter("label is not null").groupBy("label").agg(F.min("doc_id").alias("least"))
    return rows.join(stage(least, "least"), "label", "left").select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """Rows of ``docs``, all columns, one of each component: that of the smallest doc_id (null last; of rows alike in it, one).

    Rows without a set all stay.
    """
    name = free_name(docs, "row")
    keyed = stage(docs.withColumn(name, F.monotonically_increasing_id()), "rows")
    rows = component_table(keyed.select(F.col(f"`{name}`").alias("row"), "doc_id", "text")).filter("label is not null")
    first = rows.groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first")).select("label", F.col("first.row").alias("kept"))
    others = stage(rows.join(stage(first, "kept"), "label").filter("row <> kept").select(F.col("row").alias(name)), "others")
    return keyed.join(_small(others), name, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


ORACLE = r"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, list_slice(w, i, i + least(len(w), 5) - 1) AS t
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(len(w), 5) + 2)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
h AS (SELECT doc_id, hash(t) AS h FROM s),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM h a JOIN h b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 75 * (x.n + y.n - i)),
e AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
r(doc_id, c) AS (SELECT doc_id, doc_id FROM n UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.doc_id WHERE r.c < e.b)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, coalesce(m.c, d.doc_id) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT doc_id, min(c) AS c FROM r GROUP BY doc_id) m USING (doc_id)
"""
