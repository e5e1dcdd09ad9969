"""Secret scans: fixed patterns, and character Markov models compared by log-likelihood ratio.

Two Markov chains over characters are trained from labelled samples, one of random strings and one
of ordinary identifiers. A long run of key characters is a secret if the random chain explains it
better by a margin.
"""

from __future__ import annotations

import hashlib
import random
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator
from itertools import takewhile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sondelake.llm import words

KINDS = ("assign", "access", "hex", "random")
SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, n_random long, base_sha256 string, spans string"
MASK = "[SECRET]"

# Fixed patterns. Quantifiers of the last two hold the least length: a shorter match could only be
# the whole of a run, so leaving it out changes no other match.
_ASSIGN = re.compile(
    r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")

_ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
_CODE = {character: code for code, character in enumerate(_ALPHABET)}

#: Parts that the ordinary identifiers of the labelled sample are put together from.
PARTS = """
get set is has add remove create update delete find load save open close read write parse format
user account order item price total count index name value list table row column file path host
port server client request response header body message error warning event handler manager service
factory builder config option default current previous next first last time date year month day
number string text word line page document image color width height left right top bottom size
content management international communication understanding information development environment
responsibility organization administration implementation configuration
""".split()


def labelled_samples(seed: int = 7, rows: int = 1500) -> list[tuple[str, int]]:
    """Random strings (1) in the usual alphabets of keys, and ordinary identifiers (0)."""
    draw = random.Random(seed)
    alphabets = (_ALPHABET[:62], _ALPHABET[26:62], _ALPHABET[:26] + _ALPHABET[52:62], "0123456789abcdef", _ALPHABET[:64])
    samples = []
    for k in range(rows):
        samples.append(("".join(draw.choices(alphabets[k % len(alphabets)], k=draw.randint(20, 48))), 1))
        parts = draw.choices(PARTS, k=draw.randint(2, 5))
        style = k % 5
        if style == 0:
            text = "_".join(parts)
        elif style == 1:
            text = parts[0] + "".join(p.capitalize() for p in parts[1:])
        elif style == 2:
            text = "-".join(parts)
        elif style == 3:
            text = "/".join(parts) + str(draw.randint(0, 99))
        else:
            text = "".join(parts) if k % 2 else "_".join(parts).upper()
        samples.append((text, 0))
    return samples


class MarkovRatio:
    """Log-likelihood ratio of two first-order chains over the key alphabet."""

    def __init__(self, samples: Iterable[tuple[str, int]], added: float = 0.5):
        n = len(_ALPHABET)
        counts = np.full((2, n, n), added)
        for text, label in samples:
            codes = np.array([_CODE[c] for c in text if c in _CODE])
            np.add.at(counts[label], (codes[:-1], codes[1:]), 1)
        chains = np.log(counts / counts.sum(axis=2, keepdims=True))
        self.ratio = chains[1] - chains[0]

    def score(self, text: str) -> float:
        """Mean ratio per transition; above 0 the random chain is likelier."""
        codes = np.array([_CODE[c] for c in text])
        return float(self.ratio[codes[:-1], codes[1:]].mean()) if len(codes) > 1 else 0.0


#: Least mean ratio of a secret, and its least length.
THRESHOLD = 0.35
LEAST = 20
#: Letters that a run without digits must have: `xxxx` and the like are not drawn at random.
LEAST_LETTERS = 8


def is_random(run: str, model: MarkovRatio) -> bool:
    """Whether the chains call a whole run random. One without any letter never is."""
    letters = {c for c in run if c.isalpha()}
    if len(run) < LEAST or not letters or (len(letters) < LEAST_LETTERS and not any(c.isdigit() for c in run)):
        return False
    return model.score(run) > THRESHOLD


def maximal_stretches(gains: np.ndarray) -> list[tuple[int, int]]:
    """All maximal-scoring stretches of ``gains`` (Ruzzo and Tompa), in order; one pass."""
    # Start, end, sum before the stretch, sum at its end, place of the last one before with a smaller sum before it.
    found: list[tuple[int, int, float, float, int]] = []
    total = 0.0
    for k, gain in enumerate(gains.tolist()):
        before, total = total, total + gain
        if gain <= 0:
            continue
        start, at = k, len(found) - 1
        while True:
            while at >= 0 and found[at][2] >= before:
                at = found[at][4]
            if at < 0 or found[at][3] >= total:
                break
            start, before, at, stop = found[at][0], found[at][2], found[at][4], at
            del found[stop:]
        found.append((start, k + 1, before, total, at))
    return [stretch[:2] for stretch in found]


def random_parts(run: str, model: MarkovRatio) -> list[tuple[int, int]]:
    """Where ``run`` is random: all of it, or the parts that stand out from the ordinary rest.

    A part is a maximal stretch of the summed ratios above `THRESHOLD`, widened to the next `/` or `=`
    on both sides if that is random as well, as the ends of a key may look ordinary.
    """
    if is_random(run, model):
        return [(0, len(run))]
    codes = np.array([_CODE[c] for c in run])
    parts, done, judged = [], 0, None
    stops = [-1, *(k for k, c in enumerate(run) if c in "/="), len(run)]
    for start, end in maximal_stretches(model.ratio[codes[:-1], codes[1:]] - THRESHOLD):
        end += 1  # a ratio belongs to two characters
        wide = (max(done, stops[bisect_right(stops, start) - 1] + 1), stops[bisect_left(stops, end)])
        if wide != judged and is_random(run[slice(*wide)], model):
            parts.append(wide)
        elif start >= done and is_random(run[start:end], model):
            parts.append((start, end))
        judged, done = wide, parts[-1][1] if parts else 0
    return parts


def spans(text: str, model: MarkovRatio) -> list[tuple[str, int, int]]:
    """(kind, start, end) of everything found, by start, then kind. Base kinds as the patterns give
    them; parts that the chains call random are added from what base spans leave of each candidate run.
    """
    found = [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in _ACCESS.finditer(text)]
    found += [("hex", *m.span()) for m in _HEX.finditer(text)]
    base, first = sorted(s[1:] for s in found), 0
    for m in _CANDIDATE.finditer(text):
        at, rest = m.start(), []
        while first < len(base) and base[first][1] <= at:
            first += 1
        for start, end in takewhile(lambda s: s[0] < m.end(), base[first:]):
            rest.append((at, start))
            at = max(at, end)
        rest.append((at, m.end()))
        for start, end in rest:
            if len(rest) > 1:  # what joined it to a base span goes
                start += len(text[start:end]) - len(text[start:end].lstrip("/="))
                end = start + len(text[start:end].rstrip("/="))
            if end - start >= LEAST:
                found += [("random", start + a, start + b) for a, b in random_parts(text[start:end], model)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def spelled(found: Iterable[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in found)


def masked(text: str, found: Iterable[tuple[str, int, int]]) -> str:
    """The text with each stretch of overlapping spans replaced by `MASK`."""
    parts, at = [], 0
    for _, start, end in found:
        if start >= at:
            parts += [text[at:start], MASK]
        at = max(at, end)
    return "".join(parts) + text[at:]


def scan(docs: DataFrame) -> DataFrame:
    """All secrets of every whole text.

    Needs ``doc_id`` and ``text``; other columns are not looked at. Positions are code points, ends
    exclusive. A null text counts as empty. Repeated rows and ids each give their own row, a null id
    stays null, an empty table gives an empty result. Spans of different kinds may overlap. Nothing
    is shuffled; the chains are trained from `labelled_samples` in each task.
    """

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = MarkovRatio(labelled_samples())
        for batch in words.text_chunks(batches):
            found = [spans(text or "", model) for text in batch.column("text").to_pylist()]
            counts = [pa.array([sum(s[0] == kind for s in f) for f in found], pa.int64()) for kind in KINDS]
            base = [spelled(s for s in f if s[0] != "random") for f in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    *counts,
                    pa.array([hashlib.sha256(b.encode()).hexdigest() for b in base], pa.string()),
                    pa.array([spelled(f) for f in found], pa.string()),
                ],
                names=[part.split()[0] for part in SCHEMA.split(", ")],
            )

    return docs.select("doc_id", "text").mapInArrow(rows, SCHEMA)


def without_secrets(docs: DataFrame) -> DataFrame:
    """All documents and columns, with secrets in ``text`` replaced by `MASK`.

    A null text stays null. ``n_chars``, if there is such a column, follows the new text.
    """
    schema = docs.schema

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = MarkovRatio(labelled_samples())
        for batch in words.text_chunks(batches):
            texts = [t if t is None else masked(t, spans(t, model)) for t in batch.column("text").to_pylist()]
            at = batch.schema.get_field_index("text")
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    out = docs.mapInArrow(rows, schema)
    if "n_chars" not in docs.columns:
        return out
    same = F.col("text").isNull()
    length = F.when(same, F.col("n_chars")).otherwise(F.length("text")).cast(schema["n_chars"].dataType)
    return out.withColumn("n_chars", length)
