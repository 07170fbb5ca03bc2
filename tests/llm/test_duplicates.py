import hashlib
import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ratingloom.llm import ngram_join, suffix_dedup, tiling
from ratingloom.llm.components import components
from ratingloom.llm.queries import op2_ngram_join, op9_tiling
from tests.llm.conftest import sentence

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def shingles(text, width):
    words = WORDS.findall((text or "").translate(LOWER))
    if len(words) < width:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i:i + width]) for i in range(len(words) - width + 1))


def groups(texts, width, percent):
    """Size and component of each document, by all pairs that share a shingle."""
    sets = {i: shingles(t, width) for i, t in texts.items()}
    holders, common, parent = defaultdict(list), Counter(), {i: i for i in texts}
    for i, s in sets.items():
        for g in s:
            holders[g].append(i)
    for own in holders.values():
        common.update(itertools.combinations(sorted(own), 2))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for (a, b), n in common.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    return {i: (len(sets[i]), root(i)) for i in texts}


def edited(dice, words, n):
    words = list(words)
    for _ in range(n):
        words[dice.randrange(len(words))] = f"w{dice.randrange(10**6)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def near_copies(spark):
    """Families of near copies at all distances from the bound, short and long, and a common line."""
    dice = random.Random(11)
    texts = {}
    for size in (3, 8, 15, 40, 120, 400):
        for _ in range(4):
            base = [f"w{dice.randrange(10**6)}" for _ in range(size)]
            for k in range(12):
                texts[len(texts)] = edited(dice, base, dice.choice([0, 0, 1, 1, 2, size // 25, size // 18, size // 10]))
    line = " ".join(f"c{k}" for k in range(20))
    for _ in range(60):
        texts[len(texts)] = line + " " + " ".join(f"w{dice.randrange(10**6)}" for _ in range(dice.choice([2, 3, 10])))
    return texts


@pytest.mark.parametrize("width, percent", [(4, 85), (5, 80), (2, 95)])
def test_groups_equal_brute_force(spark, near_copies, monkeypatch, width, percent):
    monkeypatch.setattr(ngram_join, "BLOCK", 7)
    monkeypatch.setattr(ngram_join, "FREQUENT", 50)
    monkeypatch.setattr(ngram_join, "SEEN", 5)
    docs = spark.createDataFrame(list(near_copies.items()), "doc_id long, text string").repartition(3)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(docs, width=width, percent=percent).collect()}
    assert found == groups(near_copies, width, percent)


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 60), st.integers(0, 14), st.integers(0, 14), st.sampled_from([80, 85, 95]), st.randoms(use_true_random=False))
def test_linked_sets_meet_within_the_bounds(size, drop, add, percent, dice):
    draw = lambda n: {dice.getrandbits(64) for _ in range(n)}
    one = draw(size)
    two = set(list(one)[min(drop, size - 1):]) | draw(add)
    common = len(one & two)
    if one != two and ngram_join.linked(len(one), len(two), common, percent):
        sets = [np.array(sorted(s), np.uint64) for s in (one, two)]
        known = np.array(sorted(dice.sample(sorted(one | two), len(one | two) // 2)), np.uint64)
        rank = np.array(dice.sample(range(len(known)), len(known)), np.int64)
        owner, n, position, key = ngram_join.first_shingles(sets, percent, known, rank)
        a, b = sorted((len(s), k) for k, s in enumerate((one, two)))
        own = [dict(zip(key[owner == k].tolist(), position[owner == k].tolist())) for k in (a[1], b[1])]
        needed = -(-percent * (a[0] + b[0]) // (100 + percent))
        index = a[0] - -(-2 * percent * a[0] // (100 + percent))
        assert any(own[0][k] <= index and min(a[0] - own[0][k], b[0] - own[1][k]) >= needed for k in own[0].keys() & own[1].keys())


@pytest.mark.parametrize("core, low, high", [(60, 66, 74), (60, 73, 81)])
def test_a_common_core_makes_no_pairs_of_all(spark, monkeypatch, core, low, high):
    """Sets that share most of their words, none of them linked: the pairs compared stay few."""
    dice = random.Random(core + low)
    line = [f"c{k}" for k in range(core)]
    texts = {k: " ".join(line + [f"w{dice.randrange(10**9)}" for _ in range(dice.randint(low, high) - core)]) for k in range(1500)}
    compared = []
    rest = ngram_join._rest

    def counted(part, percent, share):
        pairs = rest(part, percent, share)
        compared.append(pairs.count())
        return pairs

    monkeypatch.setattr(ngram_join, "_rest", counted)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(docs).collect()}
    assert found == groups(texts, 4, 85)
    assert max(compared) <= 20 * len(texts)


def test_odd_documents_in_groups(spark, odd_documents, no_documents):
    found = ngram_join.near_duplicates(odd_documents).collect()
    assert Counter(r.doc_id for r in found) == Counter(r.doc_id for r in odd_documents.collect())
    by = defaultdict(set)
    for r in found:
        by[r.doc_id].add((r.n_shingles, r.component_id))
    assert by[1] == {(0, 1)} and by[2] == {(0, 2)} and by[3] == {(0, 3)}
    assert {c for _, c in by[4]} == {4} and len(by[4]) == 2
    assert {c for _, c in by[None]} == {None}
    assert ngram_join.near_duplicates(no_documents).count() == 0


def test_groups_of_the_data(spark, small_data):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small_data}/documents.parquet").collect()}
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in op2_ngram_join(spark, small_data).collect()}
    assert found == groups(texts, 4, 85)


def test_components_of_long_chains(spark):
    chain = [(k, k + 1) for k in range(60)] + [(200 - k, 199 - k) for k in range(40)] + [(300, k) for k in range(301, 340)] + [(7, 7)]
    found = {r.node: r.component for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert found == {k: 0 for k in range(61)} | {k: 160 for k in range(160, 201)} | {k: 300 for k in range(300, 340)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def removed(texts, length):
    """Digest columns by counting all windows."""
    count = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if count[t[i:i + length]] > 1:
                gone[i:i + length] = True
        low, _ = suffix_dedup._runs(gone)
        out.append((len(t), int(gone.sum()), len(low), hashlib.sha256(np.frombuffer(t, np.uint8)[~gone].tobytes()).hexdigest()))
    return out


@settings(max_examples=60, deadline=None)
@given(st.binary(min_size=1, max_size=200) | st.text("ab", min_size=1, max_size=200).map(str.encode))
def test_suffixes_are_sorted_and_prefixes_exact(data):
    data = data * 2
    order = suffix_dedup.suffix_array(data, 1 << 20)
    assert order.tolist() == sorted(range(len(data)), key=lambda i: data[i:])
    shared = suffix_dedup.common_prefixes(data, order, 1 << 20, stride=8)
    for a, b in zip(order, order[1:]):
        n = 0
        while max(a, b) + n < len(data) and data[a + n] == data[b + n]:
            n += 1
        assert shared[b] == n


def test_windows_in_shards_are_repeated_only_where_their_bytes_are():
    """Common runs just over a power of two: ties there may not let other windows join a class."""
    import pyarrow as pa

    rng = np.random.default_rng(7)
    length = 250

    def noise(n: int) -> bytes:
        return bytes(rng.integers(97, 123, n, dtype=np.uint8))

    def judge(bodies: list[bytes]) -> set[tuple[str, int]]:
        caught = []
        plain = suffix_dedup.map_groups
        suffix_dedup.map_groups = lambda table, keys, run, ddl: caught.append(run)
        try:
            suffix_dedup._in_shards(None, length)
        finally:
            suffix_dedup.map_groups = plain
        rows = pa.table({"context": [str(k) for k in range(len(bodies))], "body": bodies, "sub": [-1] * len(bodies)})
        found = caught[0](rows)
        return {(m, k) for m, a, b in zip(*found[:3]) for k in range(a, b + 1)}

    for common in range(250, 331, 4):
        for lead in range(0, 64, 7):
            run = noise(common)
            # the first run ends higher than the second; between the suffixes of both stand other texts
            tail = run[-(common - 3):]
            bodies = [noise(lead) + run + b"z" + noise(260), noise(5) + run + b"b" + noise(260)]
            bodies += [tail[k:k + 249 - k] + noise(300) for k in range(0, 6)]
            starts = Counter(b[k:k + length] for b in bodies for k in range(len(b) - length + 1))
            expected = {(str(i), k) for i, b in enumerate(bodies) for k in range(len(b) - length + 1) if starts[b[k:k + length]] > 1}
            assert judge(bodies) == expected, (common, lead)


@settings(max_examples=30, deadline=None)
@given(st.binary(max_size=300), st.binary(max_size=50))
def test_equal_windows_have_equal_anchors(middle, rest):
    shared = bytes(range(60)) + middle
    places = []
    for data in (shared + rest, rest + b"x" + shared):
        first, count, name = suffix_dedup.anchors(data, 60)
        assert count.sum() == max(0, len(data) - 59) and (np.diff(first) == count[:-1]).all()
        own = np.repeat(name, count)
        at = data.index(shared)
        places.append(own[at:at + len(shared) - 59].tolist())
    assert places[0] == places[1]


def planted_texts():
    dice = random.Random(3)
    passage = sentence(5, 120)
    texts = [sentence(k, 90) for k in range(25)]
    for k in range(12):
        texts.append(sentence(100 + k, dice.randrange(5, 60)) + passage[dice.randrange(100):] + sentence(200 + k, 20))
    texts += [texts[0]] * 3 + ["ü" * 900, "x" + "ü" * 450, "ab" * 500, sentence(9, 300) * 2, passage[:399], ""]
    return texts


@pytest.mark.parametrize("contexts, bits", [(1024, None), (2, None), (1024, 0)])
def test_repeats_equal_brute_force(spark, monkeypatch, contexts, bits):
    monkeypatch.setattr(suffix_dedup, "SHARD_CONTEXTS", contexts)
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", 3000)
    if bits is not None:
        monkeypatch.setattr(suffix_dedup, "FILTER_ANCHORS", bits)
    texts = planted_texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    found = sorted(tuple(r) for r in suffix_dedup.deduplicate(docs).collect())
    assert found == [(i, *x) for i, x in enumerate(removed([t.encode() for t in texts], 400))]


@pytest.mark.parametrize("contexts", [1024, 2])
def test_repeated_words_equal_brute_force(spark, monkeypatch, contexts):
    monkeypatch.setattr(suffix_dedup, "SHARD_CONTEXTS", contexts)
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", 3000)
    length, dice = 51, random.Random(8)
    short = " ".join(dice.choices("abcdefgh", k=140))  # 51 of these words have 101 bytes
    texts = [sentence(k, 90) for k in range(10)] + [None, "", " \n", "word", "a " * 3000]
    for k in range(14):
        at = dice.randrange(80)
        passage = short.split()[at:at + dice.choice((50, 51, 52, 60))]
        texts.append(f" {sentence(100 + k, dice.randrange(5, 60))}\n{dice.choice((' ', chr(10))).join(passage)} {sentence(200 + k, dice.choice((0, 20)))}")
    texts += [texts[0], texts[15]]
    split = [re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode()) for t in texts]
    windows = Counter(tuple(w[i:i + length]) for w in split for i in range(len(w) - length + 1))
    wanted = []
    for text, words in zip(texts, split):
        gone = {j for i in range(len(words) - length + 1) if windows[tuple(words[i:i + length])] > 1 for j in range(i, i + length)}
        pieces = re.findall(r"^[\x20\x09-\x0D]+|[^\x20\x09-\x0D]+[\x20\x09-\x0D]*", text or "")
        front = pieces.pop(0) if len(pieces) > len(words) else ""
        if len(words) - 1 in gone:  # what follows the last word stays
            front_of_end = pieces[-1].rstrip()
            tail = pieces[-1][len(front_of_end):]
        else:
            tail = ""
        wanted.append(None if text is None else front + "".join(p for j, p in enumerate(pieces) if j not in gone) + tail)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    found = suffix_dedup.deduplicate(docs, length=length, unit="words", with_text=True).orderBy("doc_id").collect()
    assert [r.kept for r in found] == wanted
    assert sum(r.n_removed > 0 for r in found) > 8


def test_places_of_a_hot_context_are_dealt_in_parts(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT_SHARE", 20)
    texts = [sentence(1, 90)] * 400 + [sentence(k, 90) for k in range(2, 40)] + [sentence(5, 90)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    dealt = []
    join = type(docs).join
    monkeypatch.setattr(type(docs), "join", lambda a, b, on=None, how=None: dealt.append((a, on)) or join(a, b, on, how))
    found = sorted(tuple(r) for r in suffix_dedup.deduplicate(docs).collect())
    assert found == [(i, *x) for i, x in enumerate(removed([t.encode() for t in texts], 400))]
    placed = next(a for a, on in dealt if on == ["context", "deal"])
    assert max(r["count"] for r in placed.groupBy("context", "deal").count().collect()) < 100


def test_repeats_in_odd_documents(odd_documents, no_documents):
    rows = odd_documents.collect()
    found = suffix_dedup.deduplicate(odd_documents, length=100, with_text=True, keep=["h", "key"]).collect()
    wanted = removed([(r.text or "").encode() for r in rows], 100)
    assert Counter(tuple(r)[:5] for r in found) == Counter((r.doc_id, *x) for r, x in zip(rows, wanted))
    assert {(r.h, r.key) for r in found} == {(1, 2)}
    assert all((r.kept is None) == (r.n_bytes == 0 and r.doc_id in (1, None)) for r in found)
    assert suffix_dedup.deduplicate(no_documents).count() == 0


def test_tiles_cover_reordered_passages():
    item = np.arange(20, dtype=np.uint64)
    swapped = np.concatenate([np.arange(50, 90), item[10:], [99], item[:10]]).astype(np.uint64)
    assert tiling.tile(item, swapped, 5) == [(0, 51, 10), (10, 40, 10)]
    assert tiling.tile(item, item[3:9], 5) == [(3, 0, 6)]
    assert tiling.tile(item, item[:4], 5) == [] and tiling.tile(item, item[:0], 5) == []
    twice = np.concatenate([item, item])
    assert tiling.tile(twice, item, 5) == [(0, 0, 20)]


def tiled_by_hand(item, document, least):
    """Tiles by looking at all pairs of places for the longest unmarked run."""
    one, two, tiles = [True] * len(item), [True] * len(document), []
    while True:
        best = (0, 0, 0)
        for i, j in itertools.product(range(len(item)), range(len(document))):
            n = 0
            while i + n < len(item) and j + n < len(document) and one[i + n] and two[j + n] and item[i + n] == document[j + n]:
                n += 1
            best = min(best, (-n, i, j))
        if -best[0] < least:
            return sorted(tiles)
        n, i, j = -best[0], best[1], best[2]
        one[i:i + n] = two[j:j + n] = [False] * n
        tiles.append(n)


@settings(max_examples=500, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=3, max_size=16), st.lists(st.integers(0, 3), max_size=24))
def test_tiles_are_common_runs_longest_first(item, document):
    tiles = tiling.tile(np.array(item, np.uint64), np.array(document, np.uint64), 3)
    for i, j, n in tiles:
        assert item[i:i + n] == document[j:j + n] and n >= 3
    assert sorted(n for _, _, n in tiles) == tiled_by_hand(item, document, 3)
    assert len({i + k for i, _, n in tiles for k in range(n)}) == sum(n for *_, n in tiles) == len({j + k for _, j, n in tiles for k in range(n)})


@pytest.mark.parametrize("sent", [8 << 20, -1])
def test_leaks_by_either_way(spark, odd_documents, no_documents, monkeypatch, sent):
    monkeypatch.setattr(tiling, "SENT_BYTES", sent)
    item = sentence(1, 30)
    words = item.split()
    items = spark.createDataFrame(
        [(1, item), (2, " ".join(words[15:] + words[:15])), (3, "unseen words altogether here now"), (4, None), (5, ""), (6, "Straße tis!"), (None, item), (1, item)],
        "item_id long, text string",
    )
    found = tiling.leaks(odd_documents, items)
    rows = Counter((r.doc_id, r.item_id, round(r.coverage, 2)) for r in found.collect())
    assert rows == Counter({(4, 1, 1.0): 4, (4, 2, 1.0): 2, (4, None, 1.0): 2, (2**60 + 1, 6, 1.0): 1})
    assert tiling.leaks(no_documents, items).count() == 0
    assert tiling.leaks(odd_documents, items.limit(0)).count() == 0


def test_leaks_of_the_data(spark, small_data):
    clean = lambda t: re.sub(r"[^a-z0-9\x80-\U0010ffff]+", " ", t.lower()).split()
    docs = {r.doc_id: " " + " ".join(clean(r.text)) + " " for r in spark.read.parquet(f"{small_data}/documents.parquet").collect()}
    items = {r.item_id: " " + " ".join(clean(r.text)) + " " for r in spark.read.parquet(f"{small_data}/benchmark.parquet").collect()}
    whole = {(d, i) for d, t in docs.items() for i, x in items.items() if x in t}
    found = {(r.doc_id, r.item_id): r.coverage for r in op9_tiling(spark, small_data).collect()}
    assert whole and whole == {k for k, c in found.items() if c == 1.0}


def test_repeats_of_the_real_documents_equal_brute_force(spark):
    """All windows of 400 bytes of the given documents at sf0.01, counted by their digests."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = docs.collect()
    texts = [(r.text or "").encode() for r in rows]
    digest = [[hashlib.blake2b(t[i:i + 400], digest_size=16).digest() for i in range(len(t) - 399)] for t in texts]
    count = Counter(d for own in digest for d in own)
    wanted = []
    for t, own in zip(texts, digest):
        gone = np.zeros(len(t), bool)
        for i, d in enumerate(own):
            if count[d] > 1:
                gone[i:i + 400] = True
        low, _ = suffix_dedup._runs(gone)
        wanted.append((len(t), int(gone.sum()), len(low), hashlib.sha256(np.frombuffer(t, np.uint8)[~gone].tobytes()).hexdigest()))
    found = Counter(tuple(r) for r in suffix_dedup.deduplicate(docs).collect())
    assert found == Counter((r.doc_id, *x) for r, x in zip(rows, wanted))
    assert sum(x[1] > 0 for x in wanted) > 0
