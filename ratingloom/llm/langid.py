"""Language identification by cross-parsing entropy.

A bounded sample of labelled text per language becomes a suffix automaton. A text is parsed into
the longest pieces that occur in that sample, one piece after the other; the language that needs
the fewest pieces, each paid with the bits of a position in its sample, wins.

The automata are dense tables, and all 256-byte blocks of a batch are parsed in step: every block
holds one state per language, and one gather moves all of them by one byte. A piece goes on across
block borders: blocks are parsed again from the state that the block before ended in, until no
state at a border changes, which it mostly does once. Whole texts are parsed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ratingloom.llm.arrow import map_batches, sliced
from ratingloom.llm.common import batches, fold

UNDETERMINED = "und"
#: Bounds of the labelled sample: documents and UTF-8 bytes for each language.
SAMPLE_DOCUMENTS = 48
SAMPLE_BYTES = 32_768
#: More languages than there are codes; bounds what is sent to all tasks.
MAX_LANGUAGES = 8_000
BLOCK = 256
_BATCH_BYTES = 4 << 20
_WORDS = bytes(b if chr(b).isalpha() or b > 127 else 32 for b in range(256))


def normalise(text: str | None) -> bytes:
    """Lower-case letters with one space between words; digits and ASCII signs are left out."""
    if not text:
        return b""
    return b" ".join(text.lower().encode("utf-8", "replace").translate(_WORDS).split())


def suffix_automaton(symbols: bytes, width: int) -> np.ndarray:
    """Transitions of the suffix automaton, a row per state; -1 where there is none."""
    move = np.full((2 * len(symbols) + 2, width), -1, np.int32)
    link, length = [-1] * len(move), [0] * len(move)
    last, used = 0, 1
    for c in symbols:
        here, used = used, used + 1
        length[here] = length[last] + 1
        p = last
        while p >= 0 and move[p, c] < 0:
            move[p, c] = here
            p = link[p]
        if p < 0:
            link[here] = 0
        else:
            q = int(move[p, c])
            if length[p] + 1 == length[q]:
                link[here] = q
            else:
                clone, used = used, used + 1
                move[clone] = move[q]
                length[clone], link[clone] = length[p] + 1, link[q]
                while p >= 0 and move[p, c] == q:
                    move[p, c] = clone
                    p = link[p]
                link[q] = link[here] = clone
        last = here
    return move[:used]


class CrossParser:
    """Counts the pieces of texts against the sample of each language."""

    def __init__(self, samples: dict[str, bytes]):
        self.languages = sorted(samples)
        seen = sorted(set(b"".join(samples.values())))
        unknown, pad = len(seen), len(seen) + 1
        self.pad = pad
        self.symbols = bytes(seen.index(b) if b in seen else unknown for b in range(256))
        self.bits = np.log2([max(2, len(samples[x])) for x in self.languages])
        self.tables = []
        for name in self.languages:
            move = suffix_automaton(samples[name].translate(self.symbols), pad + 1)
            # no way on: the piece ends, its successor starts with this byte; marked by the sign
            move = np.where(move < 0, ~np.maximum(move[0], 0), move).astype(np.int32)
            move[:, pad] = np.arange(len(move))
            self.tables.append(move.ravel())

    def pieces(self, texts: list[bytes]) -> np.ndarray:
        """Pieces needed, a row per text and a column per language."""
        out = np.zeros((len(texts), len(self.languages)))
        for lo, hi in batches(texts, _BATCH_BYTES):
            some = texts[lo:hi]
            blocks = np.array([-(-len(t) // BLOCK) for t in some])
            fill = bytes([self.pad])
            flat = b"".join(t.translate(self.symbols).ljust(int(n) * BLOCK, fill) for t, n in zip(some, blocks))
            steps = np.ascontiguousarray(np.frombuffer(flat, np.uint8).reshape(-1, BLOCK).T).astype(np.int32)
            owner = np.repeat(np.arange(len(some)), blocks)
            first = np.diff(owner, prepend=-1) > 0
            for k, table in enumerate(self.tables):
                before = np.zeros(len(owner), np.int32)
                after, ended = self._run(table, steps, before)
                while True:
                    border = np.where(first, 0, np.roll(after, 1)).astype(np.int32)
                    again = np.flatnonzero(border != before)
                    if not len(again):
                        break
                    before = border
                    after[again], ended[again] = self._run(table, steps[:, again], border[again])
                out[lo:hi, k] = np.bincount(owner, ended, len(some)) + (blocks > 0)
        return out

    def _run(self, table: np.ndarray, steps: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """States after all steps, and how many pieces ended on the way, for each column."""
        width, ended = self.pad + 1, np.zeros(steps.shape[1], np.int32)
        for row in steps:
            state = table[state * width + row]
            sign = state >> 31
            ended -= sign
            state ^= sign
        return state, ended

    def judge(self, texts: list[str | None]) -> list[tuple[str, float, float]]:
        """Language, score and bits per byte of each text."""
        out: list[tuple[str, float, float]] = [(UNDETERMINED, 0.0, 0.0)] * len(texts)
        at = [i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))]
        clean = [normalise(texts[i]) for i in at]
        if not at or not self.languages:
            return out
        size = np.array([max(1, len(t)) for t in clean])[:, None]
        cost = self.pieces(clean) * self.bits / size
        best = cost.argmin(axis=1)
        low = cost[np.arange(len(at)), best]
        score = 1 / np.exp2(-8 * (cost - low[:, None])).sum(axis=1)
        for i, b, s, c in zip(at, best, score, low):
            out[i] = (self.languages[b], float(s), float(c))
        return out


def language_samples(
    labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    documents: int = SAMPLE_DOCUMENTS, max_bytes: int = SAMPLE_BYTES,
) -> dict[str, bytes]:
    """At most ``max_bytes`` of normalised text per language, from documents picked by the hash of
    their id; of rows that repeat an id, one counts. Languages whose sample has no letters are left
    out; more than MAX_LANGUAGES are an error."""
    order = Window.partitionBy("lang").orderBy("h", "id")
    picked = (
        labelled.select(F.col(lang_col).alias("lang"), F.col(id_col).alias("id"), F.xxhash64(id_col).alias("h"))
        .where("lang is not null")
        .distinct()
        .withColumn("r", F.row_number().over(order))
        .where(F.col("r") <= documents)
        .select("lang", "id", "r")
    )
    if labelled.select(lang_col).where(F.col(lang_col).isNotNull()).distinct().limit(MAX_LANGUAGES + 1).count() > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages to learn")
    picked = F.broadcast(picked)
    # characters beyond the bound on bytes can't enter the sample
    text = F.substring(F.col(text_col), 1, max_bytes).alias("text")
    rows = labelled.select(F.col(lang_col).alias("lang"), F.col(id_col).alias("id"), text).join(picked, ["lang", "id"])
    rows = rows.groupBy("lang", "id").agg(F.min("r").alias("r"), F.min("text").alias("text"))
    found: dict[str, list[bytes]] = {}
    for r in sorted(rows.collect(), key=lambda r: (r["lang"], r["r"], r["text"] or "")):
        found.setdefault(r["lang"], []).append(normalise(r["text"]))
    share = {lang: max(1, max_bytes // max(1, len(x))) for lang, x in found.items()}
    joined = {lang: b" ".join(t[: 4 * share[lang]] for t in x)[:max_bytes] for lang, x in found.items()}
    return {lang: x for lang, x in joined.items() if x.strip()}


def identify(
    docs: DataFrame, samples: dict[str, bytes], id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None,
) -> DataFrame:
    """Each row's id with lang_pred, score and bits_per_byte, and the columns named in ``keep``.

    Null texts and texts without a letter give ``und`` and 0; so does everything if no language
    was learned. Equal texts give equal answers; rows are never dropped or merged.
    """
    keep = keep or []
    given = docs.select(F.col(text_col).alias("text__"), F.col(id_col), *keep)
    added = StructType.fromDDL("lang_pred string, score double, bits_per_byte double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        parser = CrossParser(samples)  # of this task alone, so that no worker keeps it
        for batch in sliced(batches):
            judged = parser.judge(batch.column(0).to_pylist())
            yield [*batch.columns[1:], *map(list, zip(*judged))] if judged else [*batch.columns[1:], [], [], []]

    return map_batches(given, run, StructType(given.schema.fields[1:] + added.fields))


def held_out_languages(docs: DataFrame, folds: int = 3, held: int = 1) -> DataFrame:
    """Learns from the other folds of documents and judges all of them."""
    held_out = fold("doc_id", folds) == held
    samples = language_samples(docs.where(~held_out))
    return identify(docs.withColumn("held_out", held_out), samples, keep=["held_out"])
