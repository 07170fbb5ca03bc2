"""Exact n-gram Jaccard join: links between documents whose shingle sets are similar enough.

Equal sets are one node from the start. For the others all shingles are put in one order, rare ones
first. Two linked sets share a shingle among their first few in this order, where few is what the
similarity lets them differ in: these first shingles are a set's keys, and only sets that share a key
are compared. How many documents hold a shingle is counted over all of them; the table of the most
frequent ones decides the order alone, so its fixed size costs time at worst, never a link. A line or
passage that many documents share stands last in all of them and gives no key.

A key comes with its position and the set's size. What both leave at and after the first common key
bounds the overlap, which discards most pairs before any set is looked at; of two linked sets the
smaller one needs fewer keys than the larger.

A comparison is a blocked product of the sparse incidence of documents by shingles: one set against
a block of others, overlap counts accumulated for all of them at once, pairs beyond the size bounds
discarded first. A first few rounds compare each set with the one it shares most keys with, which
joins groups of copies of any size with one comparison each; what then still meets in a key from
two components within the bounds is compared pair by pair, so that no link is lost.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratingloom.llm.arrow import map_batches, map_groups, sliced
from ratingloom.llm.common import batches, combine, discard, mix, saved, word_hashes
from ratingloom.llm.components import components

WIDTH = 4
PERCENT = 85
BLOCK = 256
ROUNDS = 2
#: After the rounds, one pair in so many is compared before all that are left.
SHARES = (16,)
#: Shingles, the most frequent ones, that the common order knows the frequency of.
FREQUENT = 1 << 18
#: Fingerprints of sets a task remembers, so as not to offer keys of equal sets again.
SEEN = 200_000
#: Shingles that are sorted or counted together in a task.
TOGETHER = 500_000
#: Bins of the sketch of a set, which bounds the overlap of two.
BINS = 256
#: Ids of sets to compare that go to every task; more are joined by a shuffle.
SENT_IDS = 2_000_000
_BATCH_BYTES = 4 << 20


def shingle_sets(texts: list[str | None], width: int) -> Iterator[np.ndarray]:
    """Sorted distinct 64-bit shingles of each text; ASCII letters count as lower case."""
    raw = [(t or "").encode("utf-8", "surrogatepass").lower() for t in texts]
    for lo, hi in batches(raw, _BATCH_BYTES):
        hashes, at = word_hashes(raw[lo:hi])
        grams = combine(hashes, width)
        for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
            if b - a >= width:
                yield np.unique(grams[a:b - width + 1])
            else:
                yield combine(hashes[a:b], b - a) if b > a else grams[:0]


def linked(a: int, b: int, common: int, percent: int) -> bool:
    return 100 * common >= percent * (a + b - common)


#: Frequent shingles stand after all others.
_LAST = np.uint64(1 << 63)


def prefix_length(n, percent: int):
    """How many first shingles of a set of ``n`` hold one of any linked set's first ones."""
    return n - -(-percent * n // 100) + 1


def required(a: str, b: str, percent: int) -> str:
    """SQL: the least overlap of linked sets of these sizes."""
    return f"(({percent} * ({a} + {b}) + {99 + percent}) div {100 + percent})"


def first_shingles(sets: list[np.ndarray], percent: int, known: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, ...]:
    """Keys of sets: number of the set, size, position and shingle. ``known`` are the frequent
    shingles in ascending order, ``rank`` their places among themselves, rare ones first."""
    sizes = np.array([len(x) for x in sets], np.int64)
    flat = np.concatenate([*sets, np.zeros(0, np.uint64)])
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = mix(flat) >> np.uint64(1)
    if len(known):
        at = np.minimum(np.searchsorted(known, flat), len(known) - 1)
        order = np.where(known[at] == flat, rank[at].astype(np.uint64) | _LAST, order)
    chosen, start = [], 0
    for n, length in zip(sizes.tolist(), prefix_length(sizes, percent).tolist()):
        chosen.append(start + np.argsort(order[start:start + n], kind="stable")[:length])
        start += n
    at = np.concatenate([*chosen, np.zeros(0, np.int64)])
    position = np.concatenate([*(np.arange(len(x)) for x in chosen), np.zeros(0, np.int64)])
    return owner[at], sizes[owner[at]], position, flat[at]


def _described(docs: DataFrame, width: int) -> DataFrame:
    """Per document its set's size and fingerprint; and, as rows with a ``shingle``, how many
    documents next to each other hold a shingle that several of them hold."""

    def several(sets: list[np.ndarray]) -> list:
        held, n = np.unique(np.concatenate([*sets, np.zeros(0, np.uint64)]), return_counts=True)
        held, n = held[n > 1].view(np.int64), n[n > 1]
        return [pa.nulls(len(n), pa.int64()), n, pa.nulls(len(n), pa.binary()), held]

    def run(given: Iterator[pa.RecordBatch]) -> Iterator[list]:
        for batch in sliced(given, 8 << 20):
            sizes, marks, sets, together = [], [], [], 0
            for own in shingle_sets(batch.column(1).to_pylist(), width):
                sizes.append(len(own))
                marks.append(_mark(own))
                sets.append(own)
                together += len(own)
                if together >= TOGETHER:
                    yield several(sets)
                    sets, together = [], 0
            yield [batch.column(0), sizes, marks, pa.nulls(len(sizes), pa.int64())]
            yield several(sets)

    return map_batches(docs, run, "id bigint, n bigint, mark binary, shingle bigint")


def _mark(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _frequent(described: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles in ascending order, and their places by frequency."""
    counted = described.where("shingle is not null").groupBy("shingle").agg(F.sum("n").alias("n"))
    rows = counted.orderBy(F.desc("n"), "shingle").limit(FREQUENT).toArrow()  # FREQUENT rows at most
    shingles, n = rows.column("shingle").to_numpy().view(np.uint64), rows.column("n").to_numpy()
    place = np.empty(len(n), np.int64)
    place[np.lexsort((shingles, n))] = np.arange(len(n))
    order = np.argsort(shingles)
    return shingles[order], place[order]


def _keys(docs: DataFrame, width: int, percent: int, frequent: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """``key, id, n, pos`` of the sets."""
    sent = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(given: Iterator[pa.RecordBatch]) -> Iterator[list]:
        known, rank = sent.value
        seen: set[bytes] = set()
        ids, sets, held = [], [], 0

        def offered() -> list:
            owner, n, position, shingle = first_shingles(sets, percent, known, rank)
            return [shingle.view(np.int64), np.array(ids, np.int64)[owner], n, position.astype(np.int32)]

        for batch in sliced(given):
            for doc_id, own in zip(batch.column(0).to_pylist(), shingle_sets(batch.column(1).to_pylist(), width)):
                if doc_id is not None and len(own) and (mark := _mark(own)) not in seen:
                    if len(seen) >= SEEN:
                        seen.clear()
                    seen.add(mark)
                    ids.append(doc_id)
                    sets.append(own)
                    held += len(own)
                    if held >= TOGETHER:
                        yield offered()
                        ids, sets, held = [], [], 0
        if ids:
            yield offered()

    return map_batches(docs, run, "key bigint, id bigint, n bigint, pos int")


def _with_sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """The sets asked for, with a sketch: how many shingles fall in each of ``BINS`` bins."""

    def run(given: Iterator[pa.RecordBatch]) -> Iterator[list]:
        for batch in sliced(given):
            sets = list(shingle_sets(batch.column(1).to_pylist(), width))
            bins = (np.bincount((x % np.uint64(BINS)).astype(np.int64), minlength=BINS) for x in sets)
            bins = [x.astype("u1" if x.max() < 256 else "<u4").tobytes() for x in bins]
            yield [batch.column(0), [len(x) for x in sets], bins, [x.tobytes() for x in sets]]

    few = wanted.limit(SENT_IDS + 1).count() <= SENT_IDS
    found = docs.join(F.broadcast(wanted) if few else wanted, "id", "left_semi")
    return map_batches(found, run, "id bigint, n bigint, sketch binary, shingles binary")


def _bins(sketch: bytes) -> np.ndarray:
    return np.frombuffer(sketch, "u1" if len(sketch) == BINS else "<u4").astype(np.int64)


def _possible(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose sizes and sketches leave room for enough common shingles."""
    one = sets.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
    two = sets.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))
    sized = pairs.join(one, "a").join(two, "b").where(f"100 * least(na, nb) >= {percent} * greatest(na, nb)")

    def run(given: Iterator[pa.RecordBatch]) -> Iterator[list]:
        for batch in given:
            a, b, na, nb = (batch.column(k).to_numpy() for k in range(4))
            for lo in range(0, len(a), 2048):
                part = slice(lo, lo + 2048)
                sa, sb = (np.array([_bins(x) for x in batch.column(k)[part].to_pylist()]) for k in (4, 5))
                most = np.minimum(sa, sb).sum(axis=1).astype(np.int64)
                keep = 100 * most >= percent * (na[part] + nb[part] - most)
                yield [a[part][keep], b[part][keep]]

    found = map_batches(sized.select("a", "b", "na", "nb", "sa", "sb"), run, "a bigint, b bigint")
    return saved(found.distinct(), "possible")


def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that are linked: each a against blocks of its bs."""
    pairs = _possible(pairs, sets, percent)
    sets = sets.select("id", "shingles")
    per = pairs.groupBy("a").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    dealt = pairs.join(per, "a").select("a", "b", F.pmod(F.xxhash64("b"), "blocks").alias("block"))
    own = per.select("a", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("block"))
    left = own.join(sets.withColumnRenamed("id", "a"), "a").select("a", "block", F.lit(None).cast("bigint").alias("b"), "shingles")
    right = dealt.join(sets.withColumnRenamed("id", "b"), "b").select("a", "block", "b", "shingles")

    def run(rows: pa.Table) -> list:
        a, b = rows.column("a")[0].as_py(), rows.column("b").to_pylist()
        raw = [np.frombuffer(x, np.uint64) for x in rows.column("shingles").to_pylist()]
        found = set()
        others = [k for k, x in enumerate(b) if x is not None]
        size = np.array([len(raw[k]) for k in others])
        for one in (raw[k] for k, x in enumerate(b) if x is None):
            near = (100 * np.minimum(size, len(one)) >= percent * np.maximum(size, len(one))) if others else []
            some = [k for k, ok in zip(others, near) if ok]
            if not some or not len(one):
                continue
            flat = np.concatenate([raw[k] for k in some])
            owner = np.repeat(np.arange(len(some)), [len(raw[k]) for k in some])
            at = np.minimum(np.searchsorted(one, flat), len(one) - 1)
            common = np.bincount(owner[one[at] == flat], minlength=len(some))
            found.update(b[k] for k, c in zip(some, common.tolist()) if linked(len(one), len(raw[k]), c, percent))
        return [[a] * len(found), sorted(found)]

    return map_groups(left.unionByName(right), ["a", "block"], run, "a bigint, b bigint")


def _component_of(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """node and component of all nodes, with or without links."""
    found = components(links)
    return saved(nodes.join(found, "node", "left").select("node", F.coalesce("component", "node").alias("component")), "components")


def _bound(percent: int) -> str:
    """SQL: what rows x and y of one key allow if it is the first key that their sets share."""
    return f"""x.key = y.key and 100 * least(x.n, y.n) >= {percent} * greatest(x.n, y.n)
        and least(x.n - x.pos, y.n - y.pos) >= {required("x.n", "y.n", percent)}"""


def _rest(part: DataFrame, percent: int, share: int) -> DataFrame:
    """Pairs of different components that share a key within the bounds of size and position: the
    smaller set by the keys it needs against larger ones, the larger by all of its own. One pair in
    ``share``, chosen by its hash."""
    n = F.col("n")
    small = part.where(F.col("pos") <= n - F.ceil(2 * percent * n / (100 + percent) - 1e-9))
    bound = f"""x.component <> y.component and (x.n < y.n or x.n = y.n and x.node < y.node)
        and pmod(xxhash64(x.node, y.node), {share}) = 0 and {_bound(percent)}"""
    pairs = small.alias("x").join(part.alias("y"), F.expr(bound))
    return saved(pairs.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct(), "rest")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, percent: int = PERCENT,
) -> DataFrame:
    """Per document: id, n_shingles and component_id, the smallest id reachable over links.

    A text with fewer than ``width`` words is one shingle, one without words (null, empty) is linked
    with nothing. Rows that repeat an id are one document of several texts: its links are theirs
    together, and each row is returned. Null ids are linked with nothing and have no component.
    """
    docs = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    described = saved(_described(docs, width), "described")
    all_rows = described.where("shingle is null").select("id", "n", "mark")
    known = all_rows.where("id is not null and n > 0")
    first = known.groupBy("mark").agg(F.min("id").alias("node"))
    of = saved(known.join(first, "mark").select("id", "node").distinct(), "nodes")

    # one shuffle by key serves the count of holders and the rows
    keys = _keys(docs, width, percent, _frequent(described)).repartition("key")
    met = keys.groupBy("key").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low < high").select("key")
    held = keys.join(met, "key", "left_semi").join(of, "id")
    held = saved(held.groupBy("key", "node", "n").agg(F.min("pos").alias("pos")), "held")
    dealt = held.repartition("key")
    shared = saved(dealt.alias("x").join(dealt.alias("y"), F.expr(f"x.node <> y.node and {_bound(percent)}"), "left_semi"), "shared")
    discard(held)

    sets = saved(_with_sets(docs.where("id is not null"), shared.select(F.col("node").alias("id")).distinct(), width), "sets")
    repeated = of.groupBy("id").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a < b").select("a", "b")
    links = repeated
    nodes = shared.select("node").distinct()
    part = shared.withColumn("component", F.col("node"))

    def contracted(links: DataFrame, part: DataFrame, pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
        more = saved(links.unionByName(_verify(pairs, sets, percent)), "links")
        new = saved(shared.join(_component_of(nodes, more), "node"), "part")
        discard(links, part, pairs)
        return more, new

    for k in range(ROUNDS):
        # every node against the one node it shares most keys with, of those that lead their keys
        lead = F.min(F.struct(F.xxhash64("node", F.lit(k)).alias("h"), "node", "n", "pos", "component"))
        leaders = part.groupBy("key").agg(lead.alias("lead"), F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
        leaders = leaders.select("key", "lead.node", "lead.n", "lead.pos", "lead.component")
        met = part.alias("x").join(leaders.alias("y"), F.expr(f"x.component <> y.component and {_bound(percent)}"))
        votes = met.groupBy(F.col("x.node").alias("b"), F.col("y.node").alias("a")).agg(F.count("*").alias("votes"))
        pairs = saved(votes.groupBy("b").agg(F.max_by("a", F.struct("votes", "a")).alias("a")).select("a", "b"), "pairs")
        links, part = contracted(links, part, pairs)
    for share in SHARES:  # part of the pairs joins most of what is linked, which spares the others
        links, part = contracted(links, part, _rest(part, percent, share))
    found = components(saved(links.unionByName(_verify(_rest(part, percent, 1), sets, percent)), "links"))
    discard(sets, shared, part)
    found = found.withColumnRenamed("component", "root")

    placed = all_rows.join(first, "mark", "left")
    placed = placed.join(found, "node", "left")
    component = F.when(F.col("n") > 0, F.coalesce("root", "node", "id")).otherwise(F.col("id"))
    return placed.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.when(F.col("id").isNotNull(), component).alias("component_id"))
