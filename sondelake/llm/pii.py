"""Personal data: fixed patterns, and a linear-chain conditional random field over word shapes.

The patterns find email and IP addresses, card and phone numbers. The field labels words as part of
a person's name or of a personal number; it looks at word shapes and cue words, is trained from a
small labelled table, and is decoded by Viterbi over many stretches of words at once.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sondelake.llm import words

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "person", "number")
SCHEMA = (
    "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, "
    "n_person long, n_number long"
)

# Fixed patterns. Possessive quantifiers and the look-behind only spare retries that cannot match.
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _emails(text: str) -> Iterator[tuple[str, int, int]]:
    """Matches of local part, `@`, domain; found from each `@`, as only that can be in the middle."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and _LOCAL.match(text, start - 1):
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        done = match.end() if match else at + 1
        if match:
            yield "email", start, done
        at = text.find("@", done)


def _luhn(digits: str) -> bool:
    total = 0
    for k, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + k % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the fixed patterns, by kind, then start."""
    found = list(_emails(text))
    for m in _IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in m[0].split(".")):
            found.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and _luhn(digits):
            found.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
                found.append(("phone", *m.span()))
    return found


# --- the field ---------------------------------------------------------------------------------

LABELS = ("O", "B-person", "I-person", "B-number", "I-number")
CUES = (
    "mr mrs ms dr prof sir name names named contact attn dear phone tel telephone mobile fax call ssn social security passport "
    "account acct iban number no id licence license customer is my your the at on in of and to by from for"
).split()
_FIRST = "+(#$€£"
_LAST = ",.:;)!?"
_SIZES = (1 + len(_FIRST) + 4, 64, 9, 1 + len(_LAST), len(CUES) + 1, len(CUES) + 1, len(CUES) + 1)
_OFFSETS = np.concatenate([[0], np.cumsum(_SIZES)[:-1]])
_LETTER = np.uint8(1)

#: Words that a decoded stretch keeps, and words of context read on each side of it.
STRETCH, CONTEXT = 64, 8


def _character_bits() -> np.ndarray:
    bits = np.zeros(256, dtype=np.uint8)
    for code in range(256):
        c = chr(code)
        bits[code] = (c.islower() * 1) | (c.isupper() * 2) | ("0" <= c <= "9") * 4 | (c == "@") * 8 | (c == "-") * 16 | (c == ".") * 32
    return bits


_BITS = _character_bits()
_CUE_ORDER = None


def _cue_ids(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    global _CUE_ORDER
    if _CUE_ORDER is None:
        joined = np.frombuffer("".join(CUES).encode("utf-32-le"), dtype=np.uint32)
        stops = np.cumsum([len(c) for c in CUES])
        hashes = words.span_hashes(joined, stops - [len(c) for c in CUES], stops)
        order = np.argsort(hashes)
        _CUE_ORDER = hashes[order], order
    hashes = words.span_hashes(codes, starts, ends)
    at = np.minimum(np.searchsorted(_CUE_ORDER[0], hashes), len(CUES) - 1)
    return np.where(_CUE_ORDER[0][at] == hashes, _CUE_ORDER[1][at] + 1, 0)


def features(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Feature numbers of each word: one of each family, as rows of an integer array."""
    small = np.minimum(codes, 255)
    bits = np.where(codes < 256, _BITS[small], _LETTER)
    lead, last = codes[starts], codes[ends - 1]
    kind = np.ones(len(starts), dtype=np.int64)
    kind[(bits[starts] & 2) > 0] = 2
    kind[(bits[starts] & 4) > 0] = 3
    kind[bits[starts] == 0] = 0
    for k, c in enumerate(_FIRST):
        kind[lead == ord(c)] = 4 + k
    inner = bits.copy()
    inner[starts] &= ~np.uint8(2)  # a capital counts as such from the second character on
    inner[ends - 1] &= ~np.uint8(32)  # a final dot ends a sentence
    shape = np.bitwise_or.reduceat(inner, starts).astype(np.int64)
    digits = np.minimum(np.add.reduceat((bits & 4 > 0).astype(np.int32), starts), 8)
    trail = np.zeros(len(starts), dtype=np.int64)
    for k, c in enumerate(_LAST):
        trail[last == ord(c)] = 1 + k
    lower = codes + np.where((codes >= 65) & (codes <= 90), 32, 0).astype(np.uint32)
    cue = _cue_ids(lower, starts, np.maximum(ends - (trail > 0), starts))
    owner = words.owners(first)
    before, after = np.zeros_like(cue), np.zeros_like(cue)
    before[1:] = np.where(owner[1:] == owner[:-1], cue[:-1], 0)
    after[:-1] = np.where(owner[1:] == owner[:-1], cue[1:], 0)
    return np.stack([kind, shape, digits, trail, cue, before, after]) + _OFFSETS[:, None]


def labelled_table(seed: int = 11, rows: int = 600) -> list[tuple[list[str], list[str]]]:
    """Short labelled sentences: words, and the label of each."""
    draw = random.Random(seed)
    names = "Anna Ben Clara David Elena Felix Greta Hugo Ines Jonas Karla Leon Maria Nora Oskar Paula Smith Jones Miller Weber Garcia Martin Dubois Rossi".split()
    filler = "the of and to house river green window walked under early quiet stone letter is that was over often people table about small".split()
    titles = "Mr Mrs Ms Dr Prof Mr. Mrs. Dr.".split()

    def digits(n: int) -> str:
        return "".join(draw.choices("0123456789", k=n))

    def plain(n: int) -> list[tuple[str, str]]:
        out = []
        for k in range(n):
            word = draw.choice(filler)
            if not k or draw.random() < 0.25:
                word = word.capitalize()
            if draw.random() < 0.12:
                word += draw.choice(",.;:")
            if draw.random() < 0.10:
                out.append((draw.choice(["is", "no", "id", "my", "in", "at", "to", "by", "on", "call", "contact"]), "O"))
                if draw.random() < 0.5:
                    word = word.capitalize()
            if draw.random() < 0.06:
                word = draw.choice([digits(1), digits(2), "20" + digits(2), digits(2) + "%", "$" + digits(3), digits(1) + "." + digits(2), "x" + digits(3), "***", digits(2) + "-" + digits(2)])
            out.append((word, "O"))
            if draw.random() < 0.06:  # words said twice or more
                out += [(word, "O")] * draw.randint(1, 3)
        return out

    def person() -> list[tuple[str, str]]:
        lead = [(draw.choice(titles), "O")] if draw.random() < 0.7 else [(w, "O") for w in draw.choice(["name:", "full name:", "Dear", "Attn:"]).split()]
        own = draw.sample(names, draw.randint(1, 2))
        if draw.random() < 0.3:
            own[-1] += draw.choice(",.")
        return lead + [(w, "B-person" if not k else "I-person") for k, w in enumerate(own)]

    def number() -> list[tuple[str, str]]:
        lead = draw.choice(["phone", "tel:", "call", "SSN", "SSN:", "passport number", "account no", "account number:", "customer id", "my phone is", "mobile:", "fax"])
        parts = draw.choice([
            [digits(3), digits(3), digits(4)], [digits(3) + "-" + digits(4)], [digits(3) + "-" + digits(2) + "-" + digits(4)],
            [digits(8)], [digits(4), digits(4), digits(4)], ["(" + digits(3) + ")", digits(3) + "-" + digits(4)], ["0" + digits(3), digits(6)],
        ])
        return [(w, "O") for w in lead.split()] + [(w, "B-number" if not k else "I-number") for k, w in enumerate(parts)]

    table = []
    for k in range(rows):
        sentence = plain(draw.randint(2, 8))
        if k % 3 == 1:
            sentence += person() + plain(draw.randint(1, 5))
        elif k % 3 == 2:
            sentence += number() + plain(draw.randint(1, 5))
        table.append(([w for w, _ in sentence], [label for _, label in sentence]))
    return table


def _encode(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Code points, and the words of each text as in `words.split_spans`."""
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)])
    blank = (codes == 32) | ((codes >= 9) & (codes <= 13))
    return codes, *words.split_spans(codes, offsets, ~blank)


class Field:
    """Weights of a linear-chain conditional random field, trained by gradient ascent."""

    def __init__(self, table: list[tuple[list[str], list[str]]], rounds: int = 120, rate: float = 0.15, shrink: float = 1e-3):
        n_labels, n_features = len(LABELS), int(sum(_SIZES))
        codes, starts, ends, first = _encode([" ".join(tokens) for tokens, _ in table])
        found = features(codes, starts, ends, first)
        sizes = np.diff(first)
        longest = int(sizes.max())
        at = first[:-1, None] + np.minimum(np.arange(longest), sizes[:, None] - 1)
        real = np.arange(longest) < sizes[:, None]
        gold = np.array([LABELS.index(label) for _, labels in table for label in labels])[at]
        rows = np.arange(len(table))

        emit, move = np.zeros((n_features, n_labels)), np.zeros((n_labels, n_labels))
        moments = [np.zeros_like(w) for w in (emit, emit, move, move)]
        for step in range(1, rounds + 1):
            scores = emit[found].sum(axis=0)[at]
            forward = np.empty_like(scores)
            backward = np.zeros_like(scores)
            forward[:, 0] = scores[:, 0]
            for k in range(1, longest):
                new = scores[:, k] + np.logaddexp.reduce(forward[:, k - 1, :, None] + move, axis=1)
                forward[:, k] = np.where(real[:, k, None], new, forward[:, k - 1])
            for k in range(longest - 2, -1, -1):
                new = np.logaddexp.reduce(move + (scores[:, k + 1] + backward[:, k + 1])[:, None, :], axis=2)
                backward[:, k] = np.where(real[:, k + 1, None], new, backward[:, k + 1])
            total = np.logaddexp.reduce(forward[:, -1], axis=1)
            chance = np.exp(forward + backward - total[:, None, None])
            push = -chance
            push[rows[:, None], np.arange(longest), gold] += 1
            push *= real[:, :, None]
            grad_emit = np.zeros_like(emit)
            flat = np.zeros((len(starts), n_labels))
            flat[at[real]] = push[real]
            for family in found:
                np.add.at(grad_emit, family, flat)
            grad_move = np.zeros_like(move)
            for k in range(1, longest):
                on = real[:, k]
                pair = forward[on, k - 1, :, None] + move + (scores[on, k] + backward[on, k])[:, None, :] - total[on, None, None]
                grad_move -= np.exp(pair).sum(axis=0)
                np.add.at(grad_move, (gold[on, k - 1], gold[on, k]), 1)
            for k, (weights, grad) in enumerate(((emit, grad_emit), (move, grad_move))):
                grad = grad / len(table) - shrink * weights
                moments[2 * k] = 0.9 * moments[2 * k] + 0.1 * grad
                moments[2 * k + 1] = 0.99 * moments[2 * k + 1] + 0.01 * grad**2
                weights += rate * (moments[2 * k] / (1 - 0.9**step)) / (np.sqrt(moments[2 * k + 1] / (1 - 0.99**step)) + 1e-8)
        # An inner label only follows its own kind.
        for kind in ("person", "number"):
            inner = LABELS.index("I-" + kind)
            for k, label in enumerate(LABELS):
                if not label.endswith(kind):
                    move[k, inner] = -1e4
        self.emit, self.move = emit.astype(np.float32), move.astype(np.float32)
        # Leaving O for r words takes r + 1 moves, at most 2 r: a stretch whose words all lose more
        # than two of the best moves can gain stays O, and needs no search.
        self.gain = 2 * max(0.0, float((self.move - self.move[0, 0]).max()))

    def decode(self, found: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Label numbers of all words. Long texts are decoded in stretches that overlap by their
        context, so that memory and the depth of the search are bounded."""
        scores = self.emit[found[0]]
        for family in found[1:]:
            scores += self.emit[family]
        sizes = np.diff(first)
        stretches = -(-sizes // STRETCH)
        text = np.repeat(np.arange(len(sizes)), stretches)
        labels = np.zeros(len(scores), dtype=np.int8)
        core = first[text] + (np.arange(len(text)) - np.repeat(np.cumsum(stretches) - stretches, stretches)) * STRETCH
        open_words = np.concatenate([[0], np.cumsum(scores[:, 1:].max(axis=1) - scores[:, 0] + self.gain >= 0)])
        low = np.maximum(core - CONTEXT, first[text])
        high = np.minimum(core + STRETCH + CONTEXT, first[text + 1])
        needed = open_words[high] > open_words[low]
        text, core = text[needed], core[needed]
        if not len(text):
            return labels
        at = core + np.arange(-CONTEXT, STRETCH + CONTEXT)[:, None]
        real = (at >= first[text]) & (at < first[text + 1])
        at = np.clip(at, 0, max(0, len(scores) - 1))
        outside = np.array([0.0] + [-1e6] * (len(LABELS) - 1), dtype=np.float32)

        back = np.empty((len(at), len(text), len(LABELS)), dtype=np.int8)
        best = np.where(real[0][:, None], scores[at[0]], outside)
        for k in range(1, len(at)):
            paths = best[:, :, None] + self.move
            back[k] = paths.argmax(axis=1)
            best = paths.max(axis=1) + np.where(real[k][:, None], scores[at[k]], outside)
        state = best.argmax(axis=1)
        rows = np.arange(len(text))
        for k in range(len(at) - 1, -1, -1):
            if CONTEXT <= k < CONTEXT + STRETCH:
                labels[at[k][real[k]]] = state[real[k]]
            if k:
                state = back[k, rows, state].astype(np.int64)
        return labels


def field_spans(field: Field, texts: list[str]) -> list[list[tuple[str, int, int]]]:
    """Names and numbers of each text, in code points, without punctuation at their ends."""
    out: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    codes, starts, ends, first = _encode(texts)
    if not len(starts):
        return out
    labels = field.decode(features(codes, starts, ends, first), first)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    begins = np.flatnonzero((labels == 1) | (labels == 3))
    of_text = np.searchsorted(first, begins, side="right") - 1
    for at, text in zip(begins.tolist(), of_text.tolist()):
        stop = at + 1
        while stop < first[text + 1] and labels[stop] == labels[at] + 1:
            stop += 1
        start, end = int(starts[at] - offsets[text]), int(ends[stop - 1] - offsets[text])
        end = start + len(texts[text][start:end].rstrip(_LAST[:4] + _LAST[5:]))
        if end > start:
            out[text].append((LABELS[labels[at]][2:], start, end))
    return out


def spans(field: Field, texts: list[str]) -> list[list[tuple[str, int, int]]]:
    """All spans of each text, by kind, then start. What the field finds is added where no base span
    covers any of it."""
    found = []
    for text, more in zip(texts, field_spans(field, texts)):
        base = base_spans(text)
        fresh = [s for s in more if not any(a < s[2] and s[1] < b for _, a, b in base)]
        found.append(base + sorted(fresh, key=lambda s: (KINDS.index(s[0]), s[1])))
    return found


def spelled(found: Iterable[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in found)


def find(docs: DataFrame) -> DataFrame:
    """All personal data of every whole text.

    Needs ``doc_id`` and ``text``; other columns are not looked at. Positions are code points, ends
    exclusive. A null text counts as empty. Repeated rows and ids each give their own row, a null id
    stays null, an empty table gives an empty result. Spans of different base kinds may overlap;
    of equal Viterbi paths the one with the earlier label wins. The field is trained on the
    driver from `labelled_table`, a few kilobytes, and broadcast; nothing is shuffled.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Field(labelled_table()))

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.text_chunks(batches):
            found = spans(shared.value, [text or "" for text in batch.column("text").to_pylist()])
            count = {kind: pa.array([sum(s[0] == kind for s in f) for f in found], pa.int64()) for kind in KINDS}
            base = [spelled(s for s in f if s[0] in BASE_KINDS) for f in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    *(count[kind] for kind in BASE_KINDS),
                    pa.array([hashlib.sha256(b.encode()).hexdigest() for b in base], pa.string()),
                    pa.array([spelled(f) for f in found], pa.string()),
                    count["person"],
                    count["number"],
                ],
                names=[part.split()[0] for part in SCHEMA.split(", ")],
            )

    return docs.select("doc_id", "text").mapInArrow(rows, SCHEMA)
