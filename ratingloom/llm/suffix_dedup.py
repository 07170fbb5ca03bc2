"""Removal of long byte strings that occur more than once anywhere, by suffix arrays.

A string of ``length`` bytes is repeated if it also starts anywhere else, in the same document or
another. Every window of ``length`` bytes has an anchor: of its 32-byte strings the one with the
smallest hash. Equal windows have equal anchors, so only windows whose anchor occurs twice matter,
and all windows of an anchor can be judged together:

1. Windows in a row with the same anchor position form a context. Contexts with a shared anchor are
   dealt to shards by anchor, equal contexts once with their number.
2. A shard's contexts get a full suffix array (Larsson-Sadakane refinement: sort by eight bytes, then
   double the depth of the groups still unsorted until none is) and the common prefixes of neighbours (Kasai's
   order: a position keeps what its predecessor had, less one byte). Windows whose neighbour agrees
   on ``length`` bytes are repeated.
3. An anchor with more contexts than a shard holds is split over shards. Each gives out a sorted run
   of fingerprints, one for each of its different windows, packed in a row for each range of
   fingerprints. The runs of a range meet in one task, and binary search finds the windows that other
   shards have too; these go back to their shards.
4. Repeated windows go back to all documents with that context, where the bytes they cover go.

The same is done in words: a text is then the string of its words' 64-bit hashes, in which a window of
so many words is one of eight times as many bytes, and only whole words go.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ratingloom.llm.arrow import map_batches, map_groups
from ratingloom.llm.common import mix, saved, word_bounds, word_hashes

LENGTH = 400
ANCHOR = 32
SHARD_BYTES = 1 << 19
#: Contexts of one anchor that a shard takes.
SHARD_CONTEXTS = 1024
#: Bits of the filter of shared anchors that goes to every task, and how many anchors it serves.
FILTER_BITS = 1 << 26
FILTER_ANCHORS = FILTER_BITS // 4
#: A context that holds more than one in so many places is dealt in several parts; there are fewer
#: such contexts than this.
HOT_SHARE = 2_000
_WEIGHTS = mix(np.arange(1, 5, dtype=np.uint64)) | np.uint64(1)
_PIECE = 8 << 20


def symbols(data: bytes, unit: str) -> bytes:
    """What windows are taken from: the text's bytes, or the hashes of its words."""
    return data if unit == "bytes" else word_hashes([data])[0].astype("<u8").tobytes()


def words_at(data: bytes, order: str = "<") -> np.ndarray:
    """The 8 bytes at every position as one number; zeros follow the end."""
    return np.ndarray((len(data),), f"{order}u8", buffer=data + bytes(8), strides=(1,)).astype(np.uint64)


def anchors(data: bytes, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First window, number of windows and anchor hash of each run of windows with one anchor."""
    found = []
    lo = 0
    while len(data) - lo >= length:  # in pieces that share length - 1 bytes
        found.append(_anchors(data[lo:lo + _PIECE + length - 1], length, lo))
        lo += _PIECE
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return tuple(map(np.concatenate, zip(*found)))


def _anchors(data: bytes, length: int, base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    eight = words_at(data)
    n = len(data) - ANCHOR + 1
    with np.errstate(over="ignore"):
        hashed = mix(sum((eight[8 * k:8 * k + n] * _WEIGHTS[k] for k in range(ANCHOR // 8)), np.zeros(n, np.uint64)))
    # smallest of the upper bits, the last of equals: its position lies in the lower 24 bits
    low = np.uint64(0xFFFFFF)
    key = (hashed & ~low) | (low - np.arange(n, dtype=np.uint64))
    wide = length - ANCHOR + 1
    blocks = -(-n // wide)
    padded = np.full(blocks * wide, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = key
    table = padded.reshape(blocks, wide)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    behind = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    windows = n - wide + 1
    at = (low - (np.minimum(behind[:windows], ahead[wide - 1:wide - 1 + windows]) & low)).astype(np.int64)
    first = np.flatnonzero(np.diff(at, prepend=-1))
    return first + base, np.diff(first, append=windows), hashed[at[first]]


def suffix_array(data: bytes, depth: int | None = None) -> np.ndarray:
    """Positions in the order of the suffixes; with ``depth`` only as far as their first ``depth``
    bytes tell them apart, which isn't enough for ``common_prefixes``."""
    n = len(data)
    key = words_at(data, ">")
    order = np.argsort(key, kind="stable")
    fresh = np.ones(n, bool)
    fresh[1:] = key[order[1:]] != key[order[:-1]]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    reach = 8
    ends = np.append(fresh[1:], True)
    open_at = np.flatnonzero(~(fresh & ends))
    while len(open_at) and (depth is None or reach < depth):
        here = order[open_at]
        beyond = here + reach
        # a suffix that ends before comes first, the shorter of two such ones too
        second = np.where(beyond < n, rank[np.minimum(beyond, n - 1)] + n + 1, n - here)
        both = rank[here] * (2 * n + 2) + second
        by = np.argsort(both, kind="stable")
        here, both = here[by], both[by]
        order[open_at] = here
        first = np.ones(len(here), bool)
        first[1:] = both[1:] != both[:-1]
        rank[here] = open_at[np.maximum.accumulate(np.where(first, np.arange(len(here)), 0))]
        last = np.append(first[1:], True)
        open_at = open_at[~(first & last)]
        reach *= 2
    return order


def common_prefixes(data: bytes, order: np.ndarray, most: int, stride: int = 64) -> np.ndarray:
    """Bytes that each suffix shares with the one before it in the order, up to ``most``.

    In text order, as Kasai's: a position shares at least what an earlier one did, less the distance.
    That holds only if ``order`` is the full order of the suffixes.
    Every ``stride``-th position is compared from the start, the others go on from there.
    """
    n = len(data)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    words = np.append(words_at(data, ">"), np.zeros(1, np.uint64))
    shared = np.zeros(n, np.int64)

    def extend(at: np.ndarray) -> None:
        at = at[before[at] >= 0]
        while len(at):
            left, right = at + shared[at], before[at] + shared[at]
            differ = words[np.minimum(left, n)] ^ words[np.minimum(right, n)]
            equal = (differ == 0) & (np.maximum(left, right) + 8 <= n)
            rest = at[~equal]
            d = differ[~equal]
            same = np.zeros(len(rest), np.int64)
            for byte in range(1, 8):
                same += (d >> np.uint64(64 - 8 * byte)) == 0
            shared[rest] = np.minimum(shared[rest] + same, n - np.maximum(rest, before[rest]))
            at = at[equal]
            shared[at] += 8
            at = at[shared[at] < most]

    extend(np.arange(0, n, stride))
    known = np.repeat(shared[::stride], stride)[:n] - np.arange(n) % stride
    others = np.flatnonzero(np.arange(n) % stride)
    shared[others] = np.where(before[others] >= 0, np.maximum(known[others], 0), 0)
    # what the next position's neighbour shares bounds it, not the neighbour itself: compare on
    extend(others)
    return np.minimum(shared, most)


def _fingerprints(data: bytes, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of the window at every position that has one."""
    out = []
    values = np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)
    n = len(data)
    for base in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F):
        power = np.full(n + 1, np.uint64(base), np.uint64)
        power[0] = 1
        power = np.multiply.accumulate(power)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(mix(values * np.uint64(base)) * power[:n], out=total[1:])
        back = np.full(n + 1, np.uint64(pow(base, -1, 1 << 64)), np.uint64)
        back[0] = 1
        back = np.multiply.accumulate(back)
        out.append(mix((total[length:] - total[:-length]) * back[:n - length + 1]))
    return out[0], out[1]


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.flatnonzero(np.diff(flags.astype(np.int8), prepend=0, append=0))
    return edge[0::2], edge[1::2] - 1


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("h"), F.col(text_col).alias("text"))


def _all_anchors(docs: DataFrame, length: int, unit: str) -> DataFrame:
    def run(given: Iterator[pa.RecordBatch]) -> Iterator[list]:
        for batch in given:
            for k, text in enumerate(batch.column(2).to_pylist()):
                first, count, name = anchors(symbols((text or "").encode("utf-8", "surrogatepass"), unit), length)
                if len(name):
                    own = batch.column(0).slice(k, 1).to_pylist() * len(name), batch.column(1).slice(k, 1).to_pylist() * len(name)
                    yield [*own, name.view(np.int64)]

    kind = docs.schema["id"].dataType.simpleString()
    return map_batches(docs, run, f"id {kind}, h bigint, anchor bigint")


def _filter(shared: DataFrame) -> np.ndarray:
    """A bit for each shared anchor, of a fixed number of bits."""
    bit = F.pmod("anchor", F.lit(FILTER_BITS))
    words = shared.select((bit / 64).cast("int").alias("word"), F.expr(f"shiftleft(1L, cast(pmod(anchor, 64) as int))").alias("bits"))
    found = words.groupBy("word").agg(F.bit_or("bits").alias("bits")).toPandas()
    out = np.zeros(FILTER_BITS // 64, np.uint64)
    out[found["word"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64).view(np.uint64)
    return out


def _contexts(docs: DataFrame, shared: DataFrame, length: int, unit: str) -> DataFrame:
    """Contexts with a shared anchor (and few others): their place, name and, once a task, bytes."""
    spark = docs.sparkSession
    kind = docs.schema["id"].dataType.simpleString()
    few = shared.limit(FILTER_ANCHORS + 1).count() <= FILTER_ANCHORS
    if few:
        bits = spark.sparkContext.broadcast(_filter(shared))
        given = docs.withColumn("wanted", F.lit(None).cast("array<bigint>"))
    else:  # too many for the filter: each document gets its own list
        own = saved(_all_anchors(docs, length, unit), "anchors").join(shared, "anchor").groupBy("id", "h").agg(F.collect_set("anchor").alias("wanted"))
        same = docs["id"].eqNullSafe(own["id"]) & (docs["h"] == own["h"])
        given = docs.join(own, same).select(docs["id"], docs["h"], docs["text"], "wanted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        seen: set[bytes] = set()
        for batch in batches:
            rows = []
            for doc_id, h, text, wanted in zip(*(c.to_pylist() for c in batch.columns)):
                data = symbols((text or "").encode("utf-8", "surrogatepass"), unit)
                first, count, name = anchors(data, length)
                if wanted is None:
                    spot = name % np.uint64(FILTER_BITS)
                    keep = (bits.value[spot // np.uint64(64)] >> (spot % np.uint64(64))) & np.uint64(1) == 1
                else:
                    keep = np.isin(name.view(np.int64), np.array(wanted, np.int64))
                for a, n, x in zip(first[keep].tolist(), count[keep].tolist(), name[keep].view(np.int64).tolist()):
                    body = data[a:a + n + length - 1]
                    mark = hashlib.blake2b(body, digest_size=16).digest()
                    rows.append((doc_id, h, x, a, n, mark, None if mark in seen else body))
                    seen.add(mark)
                if len(rows) > 20_000:
                    yield list(zip(*rows))
                    rows = []
            if rows:
                yield list(zip(*rows))

    return map_batches(given, run, f"id {kind}, h bigint, anchor bigint, at bigint, windows bigint, context binary, body binary")


#: A window that a shard gives out: two hashes, its context's number in the shard, and its offset
#: there, or the offset's complement if the shard itself holds the window twice.
_HEAD = np.dtype([("one", "<u8"), ("two", "<u8"), ("context", "<i4"), ("offset", "<i4")])
_PLACE = np.dtype([("context", "<i4"), ("offset", "<i4")])


def _in_shards(dealt: DataFrame, length: int) -> DataFrame:
    """Per shard: runs of repeated windows (context, low, high). A shard of a split anchor also gives
    out the names of its contexts, in one row, and the different windows as a sorted run, in a row
    for each range of fingerprints."""

    def run(rows: pa.Table) -> list:
        marks, bodies = rows.column("context").to_pylist(), rows.column("body").to_pylist()
        sub = rows.column("sub")[0].as_py()
        shard = rows.column("shard")[0].as_py() if sub >= 0 else None
        data = b"".join(bodies)
        sizes = np.array([len(b) for b in bodies], np.int64)
        start = np.concatenate([[0], np.cumsum(sizes)])
        owner = np.repeat(np.arange(len(bodies)), sizes)
        room = np.repeat(start[1:], sizes) - np.arange(len(data)) >= length
        order = suffix_array(data)
        prefix = common_prefixes(data, order, length)[order]
        # suffixes that agree on the length form a class; those too near a context's end don't count
        kind = np.cumsum(prefix < length)[room[order]]
        windows = order[room[order]]
        times = np.bincount(kind)[kind]
        repeated = np.zeros(len(data), bool)
        repeated[windows] = times > 1
        low, high = _runs(repeated)
        out = [(marks[owner[a]], int(a - start[owner[a]]), int(b - start[owner[a]]), shard, sub, None, None) for a, b in zip(low, high)]
        if sub >= 0:
            out.append((None, None, None, shard, sub, None, b"".join(marks)))
            first = np.diff(kind, prepend=-1) > 0
            head = windows[first]
            own = np.empty(len(head), _HEAD)
            one, two = _fingerprints(data, length)
            own["one"], own["two"], own["context"] = one[head], two[head], owner[head]
            offset = head - start[owner[head]]
            own["offset"] = np.where(times[first] > 1, ~offset, offset)
            own = own[np.lexsort((own["two"], own["one"]))]
            part = _part(own["one"], rows.column("several")[0].as_py())
            edges = np.flatnonzero(np.diff(part, prepend=-1))
            for a, b in zip(edges, np.append(edges[1:], len(own))):
                out.append((None, None, None, shard, sub, int(part[a]), own[a:b].tobytes()))
        return [list(c) for c in zip(*out)] or [[]] * 7

    return map_groups(dealt, ["shard", "sub"], run, "context binary, low bigint, high bigint, shard bigint, sub bigint, part bigint, packed binary")


def _part(one: np.ndarray, several: int) -> np.ndarray:
    """Which of so many equal ranges a fingerprint lies in."""
    return ((one >> np.uint64(32)) * np.uint64(several) >> np.uint64(32)).astype(np.int64)


def _between_shards(judged: DataFrame) -> DataFrame:
    """Runs of windows that several shards of an anchor have.

    There are as many ranges of fingerprints as the anchor has shards, so a range holds about as many
    windows as a shard. The shards' sorted runs of a range meet and every window is looked for in all
    of them by binary search; what is found goes back to its shard, packed, and becomes runs there.
    """

    def meet(rows: pa.Table) -> list:
        runs = [np.frombuffer(x, _HEAD) for x in rows.column("packed").to_pylist()]
        given = np.concatenate(runs)
        first, second = np.unique(given["one"]), np.unique(given["two"])
        # both numbers count: equal windows have equal pairs
        value = np.searchsorted(first, given["one"]) * len(second) + np.searchsorted(second, given["two"])
        merged = np.sort(value, kind="stable")
        found = np.searchsorted(merged, value, "right") - np.searchsorted(merged, value, "left") > 1
        found &= given["offset"] >= 0
        at, out = 0, []
        for sub, own in zip(rows.column("sub").to_pylist(), runs):
            here = own[found[at:at + len(own)]]
            at += len(own)
            if len(here):
                places = np.empty(len(here), _PLACE)
                places["context"], places["offset"] = here["context"], here["offset"]
                out.append((rows.column("shard")[0].as_py(), sub, 0, places.tobytes()))
        return [list(c) for c in zip(*out)] or [[]] * 4

    def back(rows: pa.Table) -> list:
        part, packed = rows.column("part").to_pylist(), rows.column("packed").to_pylist()
        marks = b"".join(x for p, x in zip(part, packed) if p is None)
        places = np.frombuffer(b"".join(x for p, x in zip(part, packed) if p is not None), _PLACE)
        places = places[np.lexsort((places["offset"], places["context"]))]
        # a run ends where the context or the next offset is another one
        step = (np.diff(places["context"], prepend=-1) != 0) | (np.diff(places["offset"], prepend=-2) != 1)
        low = np.flatnonzero(step)
        high = np.append(low[1:], len(places))[:len(low)] - 1
        names = [marks[16 * k:16 * k + 16] for k in places["context"][low].tolist()]
        return [names, places["offset"][low].astype(np.int64), places["offset"][high].astype(np.int64)]

    heads = judged.where("part is not null").select("shard", "sub", "part", "packed")
    found = map_groups(heads, ["shard", "part"], meet, "shard bigint, sub bigint, part bigint, packed binary")
    names = judged.where("packed is not null and part is null").select("shard", "sub", "part", "packed")
    return map_groups(names.unionByName(found), ["shard", "sub"], back, "context binary, low bigint, high bigint")


def repeated_ranges(docs: DataFrame, length: int, unit: str = "bytes") -> DataFrame:
    """id, h (hash of the text) and the repeated windows of each document, as ranges of starts. All
    are in bytes of what ``symbols`` makes of the text."""
    names = _all_anchors(docs, length, unit).groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1")
    shared = saved(names.select("anchor"), "shared-anchors")
    places = saved(_contexts(docs, shared, length, unit), "contexts")
    whole = places.groupBy("context").agg(
        F.count("*").alias("copies"), F.first("anchor").alias("anchor"), F.first("windows").alias("windows"), F.first("body", True).alias("body"),
    )
    whole = saved(whole, "different-contexts")
    family = whole.groupBy("anchor").agg(F.count("*").alias("n"), F.sum(F.length("body")).alias("bytes")).where("n > 1")
    family = saved(family, "families")
    size = family.agg(F.sum("bytes")).first()[0] or 0
    shards = max(1, -(-size // SHARD_BYTES))
    several = F.ceil(F.col("n") / SHARD_CONTEXTS)
    dealt = whole.join(family.select("anchor", "n"), "anchor").select(
        "context", "body",
        F.when(F.col("n") > SHARD_CONTEXTS, F.col("anchor")).otherwise(F.pmod("anchor", F.lit(shards))).alias("shard"),
        F.when(F.col("n") > SHARD_CONTEXTS, F.pmod(F.xxhash64("context"), several)).otherwise(F.lit(-1)).cast("bigint").alias("sub"),
        several.cast("bigint").alias("several"),
    )
    judged = saved(_in_shards(dealt, length), "shards")
    found = judged.where("packed is null").select("context", "low", "high")
    found = found.unionByName(_between_shards(judged))
    copied = whole.where("copies > 1").select("context", F.lit(0).cast("bigint").alias("low"), (F.col("windows") - 1).alias("high"))
    found = found.unionByName(copied)
    by_context = found.groupBy("context").agg(F.collect_set(F.struct("low", "high")).alias("ranges"))
    return _to_places(places.select("id", "h", "at", "context"), by_context, whole)


def _to_places(places: DataFrame, by_context: DataFrame, whole: DataFrame) -> DataFrame:
    """id, h, at and ranges of all places of the contexts with ranges. The places of a context that
    thousands of copies share are dealt in parts of about one in HOT_SHARE of all places."""
    share = (whole.agg(F.sum("copies")).first()[0] or 0) / HOT_SHARE
    hot = whole.where(F.col("copies") > max(share, 1)).select("context", F.ceil(F.col("copies") / max(share, 1)).alias("deal"))
    hot = F.broadcast(saved(hot, "hot-contexts"))  # fewer than HOT_SHARE rows, and 2 * HOT_SHARE parts
    deal = F.coalesce("deal", F.lit(1))
    dealt = places.join(hot, "context", "left").withColumn("deal", F.pmod(F.xxhash64("id", "h", "at"), deal))
    copied = by_context.join(hot, "context", "left").withColumn("deal", F.explode(F.sequence(F.lit(0).cast("bigint"), deal - 1)))
    return dealt.join(copied, ["context", "deal"]).select("id", "h", "at", "ranges")


def _whole_words(data: bytes, spans: list[tuple[int, int]], length: int) -> list[tuple[int, int]]:
    """Spans of the words' hashes as spans of the text, each of at least ``length`` whole words."""
    if not spans:
        return spans
    start, end = word_bounds(data)
    whole = [(-(-low // 8), high // 8) for low, high in spans]
    after = np.append(start[1:], end[-1:])
    return [(int(start[low]), int(after[high - 1])) for low, high in whole if high - low >= length]


def deduplicate(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, with_text: bool = False,
    keep: list[str] | None = None, unit: str = "bytes",
) -> DataFrame:
    """Per row: id, n_bytes, n_removed, n_spans and the SHA-256 of the bytes that stay.

    Texts are UTF-8 bytes, null is empty. With ``unit="words"`` the length is in words, between which
    any white space is as good as any other; words that go take the white space after them along, and
    a text without white space is one word. With ``with_text`` also the bytes that stay as text, where
    a character cut apart is left out, and the columns named in ``keep`` as they are. Rows that repeat id and text count as places of their own,
    so all of a long enough text goes from each.
    """
    if unit not in ("bytes", "words"):
        raise ValueError(f"unknown unit {unit!r}")
    keep = keep or []
    given = _keyed(docs, id_col, text_col)
    size = length if unit == "bytes" else 8 * length
    ranges = repeated_ranges(given, size, unit)
    given = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("h"), F.col(text_col).alias("text"), *(F.col(c).alias(f"keep_{c}") for c in keep))
    spread = ranges.select("id", "h", "at", F.explode("ranges").alias("r")).select(
        "id", "h", (F.col("at") + F.col("r.low")).alias("low"), (F.col("at") + F.col("r.high") + size).alias("high"),
    )
    own = spread.groupBy("id", "h").agg(F.collect_set(F.struct("low", "high")).alias("spans"))
    same = given["id"].eqNullSafe(own["id"]) & (given["h"] == own["h"])
    joined = given.join(own, same, "left").select(given["id"], given["text"], F.array_sort("spans").alias("spans"), *(f"keep_{c}" for c in keep))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        for batch in batches:
            rows = []
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                data = (text or "").encode("utf-8", "surrogatepass")
                kept, end, removed, count = [], 0, 0, 0
                spans = [(span["low"], span["high"]) for span in spans or []]
                if unit == "words":
                    spans = _whole_words(data, spans, length)
                for low, high in spans:
                    if low > end or not count:
                        kept.append(data[end:low])
                        count += 1
                        removed += high - low
                        end = high
                    elif high > end:
                        removed += high - end
                        end = high
                kept.append(data[end:])
                left = b"".join(kept)
                rows.append((len(data), removed, count, hashlib.sha256(left).hexdigest()) + ((None if text is None else left.decode("utf-8", "ignore")),) * with_text)
            yield [batch.column(0), *(zip(*rows) if rows else [[]] * (4 + with_text)), *batch.columns[3:]]

    kind = given.schema["id"].dataType.simpleString()
    schema = f"{id_col} {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + ", kept string" * with_text
    fields = [StructField(f.name.removeprefix("keep_"), f.dataType) for f in joined.schema.fields[3:]]
    return map_batches(joined, run, StructType(StructType.fromDDL(schema).fields + fields))
