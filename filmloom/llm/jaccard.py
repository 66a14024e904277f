"""N-gram Jaccard join with a prefix tree.

Texts become sets of hashed word n-grams; equal sets are one class, and links are sought between classes.

A set whose partner has a similarity of t shares at least t of its n-grams, so a set with too many n-grams of its own is
left out: first by a quarter of the n-grams, chosen by hash, then by all n-grams of the sets that remain. N-grams of one
set only are dropped from the others, which keep their size. The rest stand in a global order, rare ones first. Linked
sets share an n-gram of their prefixes, the first n-grams up to where too few would follow; sets that share one,
and are of like size, are joined to bundles, so every link lies within a bundle and each set is moved once. A bundle too
large for a task is cut into parts that are joined pair by pair.

In a task the ordered sets are stored in a trie, and sets are joined with all of it at once: what a set shares with the path
to a node is counted once for all sets below, and a subtree is pruned if what remains of the set, or of the longest
path below, can't make up for what is missing, or if no set below has a fitting size. Links are reduced to a
spanning set, and components found by contraction.

N-grams are compared by 64-bit hashes, sets by 128 bits: unequal n-grams of two given documents of 20,000 words meet with a
probability below 1e-10.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filmloom.llm.common import by_size, steps
from filmloom.llm.components import components
from filmloom.llm.simhash import spanning
from filmloom.operators.skew import fits_broadcast, skew_join
from filmloom.session import materialise

SHINGLE = 3
#: Least similarity, in hundredths.
PERCENT = 90
#: Share of the n-grams that the first round counts, as a bound of the hash.
SAMPLE = 1 << 62
#: Sets and n-grams of a group that a task joins at once; a larger bundle is cut into parts of half the size.
SETS, TOKENS = 512, 1_000_000
#: N-grams on one edge of the trie, at most: what is pruned is looked at after each.
RUN = 32


def shingle_hashes(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the word n-grams of a text; of all its words if there are fewer."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < shingle:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words))], np.uint64)
    grams = map(b" ".join, zip(*(islice(words, i, None) for i in range(shingle)), strict=False))
    return np.unique(np.fromiter(map(xxhash.xxh3_64_intdigest, grams), np.uint64, len(words) - shingle + 1))


def _marks(batches: Iterator[pa.RecordBatch], shingle: int, sample: int) -> Iterator[pa.RecordBatch]:
    for batch, texts in steps(batches, lambda b: b.column("text")):
        sets = [shingle_hashes(t, shingle) for t in texts]
        digests = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
        drawn = [s[: np.searchsorted(s, np.uint64(sample))].view(np.int64) for s in sets]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(digests, pa.binary()), pa.array(drawn, pa.list_(pa.int64()))],
            names=["doc_id", "n", "digest", "sample"],
        )


def _sets(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for _, texts in steps(batches, lambda b: b.column("text")):
        sets = [s for s in (shingle_hashes(t, shingle) for t in texts) if len(s)]
        digests = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
        yield pa.RecordBatch.from_arrays(
            [pa.array(digests, pa.binary()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], names=["digest", "tokens"]
        )


def _enough(shared: Column, n: Column, percent: int) -> Column:
    """Could a set of ``n`` n-grams have a partner, if ``shared`` of them occur in other sets?"""
    return 100 * shared >= percent * n


def candidate_sets(docs: DataFrame, classes: DataFrame, marks: DataFrame, shingle: int, percent: int) -> DataFrame:
    """``s, digest, n, least, order``: the classes that may have a partner, numbered, with their common n-grams
    as ``order``, an array of (df, token), rare ones first."""
    drawn = marks.filter("n > 0").select(F.xxhash64("digest").alias("mark"), F.explode("sample").alias("token"))
    ends = drawn.groupBy("token").agg(F.min("mark").alias("mark"), F.max("mark").alias("last"))
    alone = ends.filter("mark = last").groupBy("mark").agg(F.count("*").alias("alone"))
    live = classes.withColumn("mark", F.xxhash64("digest")).join(alone, "mark", "left")
    live = live.filter(_enough(F.col("n") - F.coalesce("alone", F.lit(0)), F.col("n"), percent))
    live = materialise(live.select("digest", "n", "least"), "live")
    # The texts of the classes left: of any row with the class's smallest id.
    wanted = materialise(live.select(F.col("least").alias("doc_id")).distinct(), "live-ids")
    wanted = F.broadcast(wanted) if fits_broadcast(wanted) else wanted
    texts = docs.join(wanted, docs["doc_id"].eqNullSafe(wanted["doc_id"]), "left_semi").select("text")
    sets = texts.mapInArrow(lambda it: _sets(it, shingle), "digest binary, tokens array<bigint>")
    sets = sets.groupBy("digest").agg(F.first("tokens").alias("tokens")).join(live, "digest")
    sets = materialise(sets.withColumn("s", F.monotonically_increasing_id()), "sets")
    facts = sets.select("s", F.explode("tokens").alias("token"))
    df = materialise(facts.groupBy("token").agg(F.count("*").alias("df")).filter("df > 1"), "frequencies")
    common = skew_join(facts, df, ["token"], "inner", salt_by=["s"])
    order = common.groupBy("s").agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("order"))
    kept = sets.drop("tokens").join(order, "s").filter(_enough(F.size("order"), F.col("n"), percent))
    return materialise(kept, "ordered")


def bundles(ordered: DataFrame, percent: int) -> DataFrame:
    """``s, root``: sets that share an n-gram of their prefixes and are of like size have one root, directly or by others."""
    n = F.col("n")
    least = F.ceil(n * percent / F.lit(100.0)).cast("long")
    own = n - F.size("order")
    prefix = F.slice("order", F.lit(1), F.greatest(F.lit(1), n - least + 1 - own).cast("int"))
    # Sizes of linked sets are in one band or two neighbours; a band is a little wider than need be, for rounding.
    band = F.floor(F.log(n) / F.lit(-float(np.log(percent / 100 - 0.01))))
    entries = ordered.select("s", band.alias("low"), F.explode(prefix).alias("e"))
    entries = entries.select("s", "e.token", F.explode(F.array("low", F.col("low") + 1)).alias("band"))
    # N-grams are negative nodes beside the sets; two that fell on one node would only make a bundle larger.
    node = -F.xxhash64("token", "band").bitwiseAND(F.lit((1 << 63) - 1)) - 1
    return components(entries.select(F.col("s").alias("a"), node.alias("b"))).filter("node >= 0").withColumnRenamed("node", "s")


class Trie:
    """A radix tree of ordered sets with edges of at most ``run`` tokens.

    ``sets`` are ascending places in a vocabulary, ``sizes`` what the sets count in full. Nodes are numbered from 0, the
    root; ``first`` and ``last`` bound the sets below a node by their rank in the tree's order, ``order``.
    """

    def __init__(self, sets: list[np.ndarray], sizes: np.ndarray, run: int = RUN):
        keys = [s.astype(">u4").tobytes() for s in sets]
        self.order = np.array(sorted(range(len(sets)), key=keys.__getitem__))
        ordered = [sets[i] for i in self.order]
        lengths = np.array([len(s) for s in ordered])
        self.tokens, self.base = np.concatenate(ordered), np.cumsum(lengths) - lengths
        self.sizes = sizes[self.order]
        end, low, parent, high, stack, ending = [0], [0], [-1], [len(sets)], [0], []
        for i, s in enumerate(ordered):
            same = 0 if not i else _common(ordered[i - 1], s)
            below = -1
            while end[stack[-1]] > same:
                below = stack.pop()
                high[below] = i
            if end[stack[-1]] < same:
                end.append(same), low.append(low[below]), parent.append(stack[-1]), high.append(-1)
                parent[below] = len(end) - 1
                stack.append(len(end) - 1)
            if len(s) > same:
                end.append(len(s)), low.append(i), parent.append(stack[-1]), high.append(-1)
                stack.append(len(end) - 1)
            ending.append(stack[-1])
        for node in stack:
            high[node] = len(sets)
        self._cut(np.array(end), np.array(low), np.array(parent), np.array(high), np.array(ending), lengths, run)

    def _cut(self, end, low, parent, high, ending, lengths, run) -> None:
        """Cut long edges, and note for each node what lies below."""
        start = np.where(parent < 0, 0, end[np.maximum(parent, 0)])
        pieces = np.maximum(1, -(-(end - start) // run))
        first = np.cumsum(pieces) - pieces
        node = np.repeat(np.arange(len(end)), pieces)
        nth = np.arange(len(node)) - first[node]
        self.start = start[node] + nth * run
        self.end = np.minimum(end[node], self.start + run)
        above = np.where(parent < 0, -1, (first + pieces - 1)[np.maximum(parent, 0)])
        self.parent = np.where(nth > 0, np.arange(len(node)) - 1, above[node])
        self.first, self.last = low[node], high[node]
        # Smallest and largest size, and longest path, of the sets below: by ranges of the tree's order.
        self.least = np.array([self.sizes[a:b].min() for a, b in zip(low, high, strict=True)])[node]
        self.most = np.array([self.sizes[a:b].max() for a, b in zip(low, high, strict=True)])[node]
        self.longest = np.array([lengths[a:b].max() for a, b in zip(low, high, strict=True)])[node]
        children = np.argsort(self.parent, kind="stable")
        edges = np.searchsorted(self.parent[children], np.arange(len(node) + 1))
        self.children, self.child = children, edges
        at = (first + pieces - 1)[ending]
        self.ending = np.argsort(at, kind="stable")
        self.ends = np.searchsorted(at[self.ending], np.arange(len(node) + 1))

    def below(self, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Children of each node, with the place of their parent in ``nodes``."""
        return _gathered(self.children, self.child, nodes)

    def sets_at(self, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks of the sets that end at each node, with its place in ``nodes``."""
        return _gathered(self.ending, self.ends, nodes)


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the common start of two arrays."""
    n = min(len(a), len(b))
    differ = a[:n] != b[:n]
    return int(differ.argmax()) if differ.any() else n


def _gathered(values: np.ndarray, edges: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = edges[keys + 1] - edges[keys]
    owner = np.repeat(np.arange(len(keys)), n)
    return values[np.repeat(edges[keys] - np.cumsum(n) + n, n) + np.arange(n.sum())], owner


def trie_links(trie: Trie, sets: list[np.ndarray], sizes: np.ndarray, places: np.ndarray, words: int, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (place in ``sets``, rank in the trie) of at least the similarity, some sets at a time.

    ``places`` are the ranks in the trie after which a set looks for partners, -1 for all. ``words``: size of the vocabulary.
    """
    step = max(1, min(64, (4 << 20) // max(1, words), (1 << 17) // len(trie.sizes)))
    for at in range(0, len(sets), step):
        some = sets[at : at + step]
        n, after = sizes[at : at + step], places[at : at + step]
        held = np.zeros((len(some), words), bool)
        for i, s in enumerate(some):
            held[i, s] = True
        upto = np.cumsum(held, axis=1, dtype=np.int32)
        q = np.arange(len(some))
        node, got = np.zeros(len(some), np.int64), np.zeros(len(some), np.int64)
        while len(q):
            node, owner = trie.below(node)
            q, got = q[owner], got[owner]
            # Sizes that fit, and sets not compared before.
            fit = (100 * trie.most[node] >= percent * n[q]) & (100 * n[q] >= percent * trie.least[node]) & (trie.last[node] > after[q] + 1)
            q, node, got = q[fit], node[fit], got[fit]
            if not len(q):
                break
            length = trie.end[node] - trie.start[node]
            spot = np.repeat(trie.base[trie.first[node]] + trie.start[node] - np.cumsum(length) + length, length) + np.arange(length.sum())
            got = got + np.add.reduceat(held[np.repeat(q, length), trie.tokens[spot]], np.cumsum(length) - length, dtype=np.int64)
            y, owner = trie.sets_at(node)
            x, overlap = q[owner], got[owner]
            linked = (100 * overlap >= percent * (n[x] + trie.sizes[y] - overlap)) & (y > after[x])
            if linked.any():
                yield x[linked] + at, y[linked]
            # What remains of the set after this node, and of the longest path below it.
            final = trie.tokens[trie.base[trie.first[node]] + trie.end[node] - 1]
            reach = got + np.minimum(upto[q, -1] - upto[q, final], trie.longest[node] - trie.end[node])
            least = np.maximum(trie.least[node], -(-percent * n[q] // 100))
            alive = (100 + percent) * reach >= percent * (n[q] + least)
            q, node, got = q[alive], node[alive], got[alive]


def group_links(ids: np.ndarray, sizes: np.ndarray, left: np.ndarray, right: np.ndarray, tokens: list[np.ndarray], dfs: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between the sets marked ``left`` and those marked ``right`` (all of them both, or none), as a spanning set."""
    flat, df = np.concatenate(tokens), np.concatenate(dfs)
    vocabulary, where = np.unique(flat, return_index=True)
    rank = np.empty(len(vocabulary), np.int64)
    rank[np.lexsort((vocabulary, df[where]))] = np.arange(len(vocabulary))
    cuts = np.cumsum([len(t) for t in tokens])[:-1]
    sets = [np.sort(s) for s in np.split(rank[np.searchsorted(vocabulary, flat)], cuts)]
    stored, asked = np.flatnonzero(right), np.flatnonzero(left)
    trie = Trie([sets[i] for i in stored], sizes[stored])
    places = np.full(len(ids), -1)
    if left.all():
        places[stored[trie.order]] = np.arange(len(stored))
    a, b = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for x, y in trie_links(trie, [sets[i] for i in asked], sizes[asked], places[asked], len(vocabulary), percent):
        a, b = np.concatenate((a, asked[x])), np.concatenate((b, stored[trie.order[y]]))
        if len(a) > 8 * len(ids):
            a, b = spanning(a, b, len(ids))
    if len(a):
        a, b = spanning(a, b, len(ids))
    return ids[a], ids[b]


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The groups (root, part) of sorted rows, one at a time."""
    pending, key = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy() for c in ("root", "part")], 1)
        cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if pending and key != tuple(keys[a]):
                yield pa.Table.from_batches(pending)
                pending = []
            key = tuple(keys[a])
            pending.append(batch.slice(a, b - a))
    if pending:
        yield pa.Table.from_batches(pending)


def _links(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for group in _grouped(batches):
        if group.num_rows > 1:
            arrays = lambda c, group=group: [np.asarray(x.values) for x in group.column(c)]
            own, first, second = (group.column(c).to_numpy() for c in ("own", "first", "second"))
            left, right = own == first, own == second
            if left.any() and right.any():
                a, b = group_links(group.column("s").to_numpy(), group.column("n").to_numpy(), left, right, arrays("tokens"), arrays("dfs"), percent)
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def set_links(ordered: DataFrame, percent: int) -> DataFrame:
    """Edges ``a, b`` between the sets of ``ordered`` that join the same ones as all links."""
    spark = ordered.sparkSession
    placed = materialise(ordered.join(bundles(ordered, percent), "s").select("root", "s", "n", F.col("order.token").alias("tokens"), F.col("order.df").alias("dfs")), "bundles")
    sizes = placed.groupBy("root").agg(F.count("*").alias("sets"), F.sum(F.size("tokens")).alias("held"))
    parts = F.greatest(F.ceil(F.col("sets") / F.lit(SETS // 2)), F.ceil(F.col("held") / F.lit(TOKENS // 2))).cast("int")
    crowded = materialise(sizes.filter((F.col("sets") > SETS) | (F.col("held") > TOKENS)).select("root", parts.alias("parts")), "crowds")
    if crowded.isEmpty():
        dealt = placed.select("*", F.lit(0).alias("own"), F.lit(0).alias("first"), F.lit(0).alias("second"))
    else:
        dealt = placed.join(F.broadcast(crowded) if fits_broadcast(crowded) else crowded, "root", "left")
        dealt = dealt.withColumn("parts", F.coalesce("parts", F.lit(1))).withColumn("own", F.pmod(F.xxhash64("s"), F.col("parts")).cast("int"))
        others = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda p: F.struct(F.least(p, F.col("own")).alias("first"), F.greatest(p, F.col("own")).alias("second")))
        dealt = dealt.withColumn("pair", F.explode(others)).select("*", "pair.first", "pair.second").drop("pair", "parts")
    dealt = dealt.withColumn("part", F.xxhash64("first", "second"))
    tasks = by_size(spark, placed.count(), 20_000)
    dealt = dealt.repartition(tasks, "root", "part").sortWithinPartitions("root", "part")
    return dealt.mapInArrow(lambda it: _links(it, percent), "a bigint, b bigint")


def jaccard_components(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs`` (doc_id, text).

    ``n_shingles`` is the size of the text's set of word n-grams, ``component_id`` the smallest doc_id that links of at
    least ``percent`` hundredths Jaccard similarity reach, the row's own included. Null, empty and wordless texts have an
    empty set, which links with nothing: they keep their own id. Repeated rows each come back. A null id takes no part
    in the smallest, which is null only if no row reached has an id. Other columns are not read.
    """
    docs = docs.select("doc_id", "text")
    doc_id = docs.schema["doc_id"].dataType.simpleString()
    kind = f"doc_id {doc_id}, n bigint, digest binary, sample array<bigint>"
    marks = materialise(docs.mapInArrow(lambda it: _marks(it, shingle, SAMPLE), kind), "marks")
    classes = marks.filter("n > 0").groupBy("digest").agg(F.first("n").alias("n"), F.min("doc_id").alias("least"))
    classes = materialise(classes, "classes")
    ordered = candidate_sets(docs, classes, marks, shingle, percent)
    roots = components(set_links(ordered, percent)).withColumnRenamed("node", "s")
    linked = ordered.select("s", "digest", "least").join(roots, "s")
    firsts = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    linked = materialise(linked.join(firsts, "root").select("digest", "component_id"), "linked")
    labels = classes.join(linked, "digest", "left").select("digest", F.coalesce("component_id", "least").alias("component_id"))
    counted = marks.select("doc_id", F.col("n").alias("n_shingles"), "digest")
    joined = counted.filter("n_shingles > 0").join(labels, "digest", "left").select("doc_id", "n_shingles", "component_id")
    return joined.unionByName(counted.filter("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
