"""Line-first cleaning: judge every line, take failing lines out, reject what loses too much.

A line fails if it is navigation (items between separators, or a short scrap without an end),
boilerplate (legal, cookie and account phrases), full of signs, shouted, stuttered (most words equal
to the one before), or repeats an earlier line.
What is left is the cleaned text. A document is rejected if it fails the base limits, or if the
failed lines held more than ``MOST_LOST`` of its word characters.

The base figures count words (runs of characters outside the six ASCII space characters) in whole
texts; 8-word windows found twice are counted over all windows of a document.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.llm.arrow import map_batches
from ratingloom.llm.common import batches, combine, word_hashes

WINDOW = 8
LEAST_WORDS = 20
#: Limits in percent.
MOST_REPEATED = 30
MOST_LOST = 50
#: Words a line without an end mark needs in order not to count as a scrap.
SCRAP_WORDS = 8
_BATCH_BYTES = 4 << 20
_SYMBOLS = re.compile(r"[#*$%&|<>]")
_SPACES = re.compile(r"[\x20\x09-\x0D]")
_END = re.compile(r"[.!?…。！？:;\"'”’»)\]]\s*$")
_SEPARATOR = re.compile(r"(?:^|\s)[|»›·•>](?=\s|$)")
_SHOUT = re.compile(r"[A-ZÀ-ÖØ-Þ]")
_SMALL = re.compile(r"[a-zß-öø-ÿ]")
# Fixed phrases of web boilerplate.
_BOILERPLATE = re.compile(
    r"all rights reserved|copyright ©|licensed under|license[,]? version|privacy policy|terms of (?:use|service)|"
    r"cookie|enable javascript|sign in|log ?in|subscribe|click here|lorem ipsum|powered by|share this|read more",
    re.IGNORECASE,
)


def line_fails(line: str) -> bool:
    """Whether a line with a word is no running text."""
    words = line.split()
    marks = len(_SYMBOLS.findall(line))
    if 3 * len(_SEPARATOR.findall(line)) > len(words):
        return True
    if 10 * marks > len(line) and marks >= 3:
        return True
    if len(line) < 200 and _BOILERPLATE.search(line):
        return True
    if len(words) >= 4 and 2 * sum(a == b for a, b in zip(words, words[1:])) > len(words):
        return True
    if len(words) < SCRAP_WORDS and not _END.search(line):
        return True
    capitals = len(_SHOUT.findall(line))
    return capitals >= 10 and capitals > 4 * len(_SMALL.findall(line))


def repeated_words(hashes: np.ndarray, offsets: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """For each text, its words that lie in a window found at least twice in the text."""
    out = np.zeros(len(offsets) - 1, np.int64)
    grams = combine(hashes, window)
    for i in np.flatnonzero(np.diff(offsets) > window):
        a, b = offsets[i], offsets[i + 1]
        own = grams[a:b - window + 1]
        order = np.sort(own)
        twice = order[1:][order[1:] == order[:-1]]
        if len(twice):
            hit = np.isin(own, twice)
            cover = np.zeros(b - a + 1, np.int64)
            np.add.at(cover, np.flatnonzero(hit), 1)
            np.add.at(cover, np.flatnonzero(hit) + window, -1)
            out[i] = np.count_nonzero(np.cumsum(cover[:-1]))
    return out


def clean(text: str) -> tuple[str, int, int, int]:
    """Cleaned text, failed lines, repeated lines, and word characters of all failed lines."""
    kept, seen = [], set()
    failed = repeated = lost = 0
    for line in text.split("\n"):
        bare = _SPACES.sub("", line)
        if not bare:
            kept.append(line)
            continue
        again = line in seen
        seen.add(line)
        repeated += again
        if again or line_fails(line):
            failed += 1
            lost += len(bare)
        else:
            kept.append(line)
    return "\n".join(kept), failed, repeated, lost


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """A row per document: base figures, failed lines, the share of word characters they held, and
    the verdict; with ``with_text`` also the cleaned text.

    Null and empty texts have no words and fail the base limits. Rows that repeat an id are judged
    each on its own.
    """
    schema = (
        f"{id_col} {dict(docs.dtypes)[id_col]}, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
        "n_repeat_words bigint, base_failed boolean, kept boolean, n_failed_lines bigint, lost_share double"
        + ", cleaned string" * with_text
    )

    def run(given: Iterator[pa.RecordBatch]) -> Iterator[list]:
        for batch in given:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            raw = [t.encode("utf-8", "surrogatepass") for t in texts]
            for lo, hi in batches(raw, _BATCH_BYTES):
                hashes, offsets = word_hashes(raw[lo:hi])
                repeat, rows = repeated_words(hashes, offsets), []
                for i in range(lo, hi):
                    text, n = texts[i], int(offsets[i - lo + 1] - offsets[i - lo])
                    again = int(repeat[i - lo])
                    chars = len(_SPACES.sub("", text))
                    cleaned, failed, repeated, lost = clean(text)
                    base = n < LEAST_WORDS or 100 * again > MOST_REPEATED * n
                    good = not base and 100 * lost <= MOST_LOST * chars
                    rows.append((n, chars, len(_SYMBOLS.findall(text)), repeated, again, base, good, failed, lost / max(1, chars)) + (cleaned,) * with_text)
                yield [batch.column(0).slice(lo, hi - lo), *zip(*rows)]

    return map_batches(docs.select(F.col(id_col), F.col(text_col)), run, schema)
