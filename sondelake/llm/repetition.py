"""Quality rules from repetition coverage.

Rolling hashes of several n-gram lengths find the n-grams that a text holds more than once; what
counts is the share of characters that lie inside them, and inside repeated lines.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sondelake.llm import words

#: n-gram length: largest share of word characters that may lie inside repeated n-grams.
LIMITS = {5: 0.15, 7: 0.13, 10: 0.10}
#: Largest share of word characters that may lie in lines equal to an earlier line.
LINE_LIMIT = 0.30
BASE_WIDTH = 3

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, base_failed boolean, kept boolean, dup_line_chars long, "
    + ", ".join(f"dup_chars_{n} long" for n in LIMITS)
)

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True


def _repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marks of keys that occur more than once, and of those that are not one chosen of their kind."""
    order = np.argsort(keys)
    ordered = keys[order]
    same = np.zeros(len(keys) + 1, dtype=bool)
    same[1:-1] = ordered[1:] == ordered[:-1]
    again, many = np.zeros(len(keys), dtype=bool), np.zeros(len(keys), dtype=bool)
    again[order] = same[:-1]
    many[order] = same[:-1] | same[1:]
    return many, again


def _of_text(hashes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    return words.mix(hashes ^ words.mix(owner.astype(np.uint64) + np.uint64(1)))


def measure(texts: pa.Array) -> dict[str, np.ndarray]:
    """All counts for the texts of one chunk."""
    data, offsets = words.utf8(texts)
    inside = words.NON_BLANK[data]
    starts, ends, first = words.split_spans(data, offsets, inside)
    owner = words.owners(first)
    hashes = words.span_hashes(data, starts, ends)
    # Code points begin at every byte that is not a UTF-8 continuation.
    leads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80, dtype=np.int64)])
    chars = leads[ends] - leads[starts]
    symbols = np.concatenate([[0], np.cumsum(_SYMBOL[data], dtype=np.int64)])

    found = {
        "n_words": np.diff(first),
        "word_chars": words.sums_by_text(chars, first),
        "n_symbols": symbols[offsets[1:]] - symbols[offsets[:-1]],
    }
    for width in (BASE_WIDTH, *LIMITS):
        at = words.ngram_starts(first, width)
        many, _ = _repeated(_of_text(words.ngram_hashes(hashes, width)[at], owner[at]))
        hit = words.covered(len(starts), at[many], width)
        if width == BASE_WIDTH:
            found["n_repeat_words"] = words.sums_by_text(hit, first)
        else:
            found[f"dup_chars_{width}"] = words.sums_by_text(np.where(hit, chars, 0), first)

    # A line with a word is known by its span; equal spans in one text are repeats.
    line_starts, line_ends, first_line = words.split_spans(data, offsets, data != 10)
    word_of = np.searchsorted(starts, line_starts), np.searchsorted(starts, line_ends)
    has_word = word_of[1] > word_of[0]
    line_owner = words.owners(first_line)
    line_hashes = words.span_hashes(data, line_starts, line_ends)
    again = np.zeros(len(line_starts), dtype=bool)
    again[has_word] = _repeated(_of_text(line_hashes[has_word], line_owner[has_word]))[1]
    found["n_dup_lines"] = words.sums_by_text(again, first_line)
    char_sums = np.concatenate([[0], np.cumsum(chars, dtype=np.int64)])
    line_chars = char_sums[word_of[1]] - char_sums[word_of[0]]
    found["dup_line_chars"] = words.sums_by_text(np.where(again, line_chars, 0), first_line)

    n_words = found["n_words"]
    failed = (n_words < 50) | (100 * found["n_repeat_words"] > 50 * n_words)
    rejected = found["dup_line_chars"] > LINE_LIMIT * found["word_chars"]
    for width, limit in LIMITS.items():
        rejected |= found[f"dup_chars_{width}"] > limit * found["word_chars"]
    return found | {"base_failed": failed, "kept": ~failed & ~rejected}


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [part.split()[0] for part in SCHEMA.split(", ")]
    for batch in words.text_chunks(batches):
        found = measure(batch.column("text"))
        columns = [batch.column("doc_id"), *(pa.array(found[name]) for name in names[1:])]
        yield pa.RecordBatch.from_arrays(columns, names=names)


def repetition_rules(docs: DataFrame) -> DataFrame:
    """Word, symbol and repetition counts of every text, and whether the text is kept.

    Needs ``doc_id`` and ``text``; other columns are not looked at. One narrow stage: a text is
    judged alone, whole, and in chunks of about a megabyte of text. A null text counts as empty: no
    words, ``base_failed`` is true. Repeated rows and ids each give their own row, a null id stays
    null, an empty table gives an empty result. Two n-grams count as equal when their 64-bit hashes
    are equal; of equal lines all but one are repeats.
    """
    return docs.select("doc_id", "text").mapInArrow(_rows, SCHEMA)
