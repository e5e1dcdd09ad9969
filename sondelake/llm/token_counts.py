"""Token counts by a tokenizer compiled to finite-state transducers.

Two deterministic transducers are compiled from a byte-pair vocabulary with word ends:

* The *scanner* reads character classes and marks where a piece (a word, one digit, a run of
  symbols, a contraction) begins. Texts are cut into chunks of `CHUNK` characters; each chunk is a
  map from the state before it to the state after it, and the maps compose through a parallel
  prefix scan, so that no position waits for all those before it.
* The *piece transducer* has the tokens as states. A transition from token ``a`` to token ``b``
  emits one token and exists if ``a`` and ``b`` next to each other stay as they are under the merge
  rules. The tokens of a piece are the only path through it, which makes the machine
  deterministic; transitions are compiled when first met and kept.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sondelake.llm import words

CHUNK = 64
#: Pieces whose counts a worker remembers; further ones are counted each time they are met.
REMEMBERED = 2_000_000
SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"

# Character classes of the scanner.
_SPACE, _LETTER, _NUMBER, _OTHER, _APOSTROPHE_1, _APOSTROPHE_2 = range(6)
# Its states: outside a piece, in letters, in symbols, one or two letters of a contraction to go.
_OUT, _LETTERS, _SYMBOLS, _ONE, _TWO = range(5)
_STATES = 5

# Fixed values of the vocabulary's splitting rule: contractions by the number of their letters.
_CONTRACTIONS_1 = "stmd"
_CONTRACTIONS_2 = ("re", "ve", "ll")


def _scanner() -> tuple[np.ndarray, np.ndarray]:
    """Next state and 'a piece begins here', by class and state."""
    to = np.zeros((6, _STATES), dtype=np.uint8)
    begins = np.zeros((6, _STATES), dtype=bool)
    to[_LETTER] = _LETTERS
    begins[_LETTER] = True
    begins[_LETTER, [_LETTERS, _ONE, _TWO]] = False
    to[_LETTER, _ONE], to[_LETTER, _TWO] = _OUT, _ONE
    begins[_NUMBER] = True
    for kind, state in ((_OTHER, _SYMBOLS), (_APOSTROPHE_1, _ONE), (_APOSTROPHE_2, _TWO)):
        to[kind], begins[kind] = state, True
        to[kind, _SYMBOLS], begins[kind, _SYMBOLS] = _SYMBOLS, False
    return to, begins


_TO, _BEGINS = _scanner()


def character_classes(spec: dict) -> np.ndarray:
    """Class of every code point, found by asking the vocabulary's own splitting rule.

    Each character is probed doubled between two letters: letters join all four, numbers part all
    four, white space drops out, and anything else stays together in the middle.
    """
    from tokenizers import Regex
    from tokenizers.pre_tokenizers import Split

    rule = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
    splitter = Split(Regex(rule["pattern"]["Regex"]), rule["behavior"].lower(), invert=rule["invert"])
    classes = np.full(0x110000, _OTHER, dtype=np.uint8)
    # Planes 3 to 13 and from 15 on hold no character of another class.
    for block in (*range(0, 0x33000, 4096), 0xE0000):
        codes = [code for code in range(block, block + 4096) if not 0xD800 <= code < 0xE000]
        pieces = splitter.pre_tokenize_str("\n".join("a" + 2 * chr(code) + "a" for code in codes))
        starts = np.array([start for _, (start, _) in pieces]) // 5
        per_probe = np.bincount(starts, minlength=len(codes))
        kind = np.array([_OTHER, _LETTER, _SPACE, _OTHER, _NUMBER], dtype=np.uint8)
        classes[codes] = kind[per_probe]
    return classes


def scan(classes: np.ndarray) -> np.ndarray:
    """State before each position, starting outside a piece."""
    n = len(classes)
    blocks = -(-n // CHUNK)
    padded = np.zeros(blocks * CHUNK, dtype=np.uint8)
    padded[:n] = classes
    columns = np.ascontiguousarray(padded.reshape(blocks, CHUNK).T)
    table = _TO.reshape(-1)
    row = columns * np.uint8(_STATES)

    maps = np.tile(np.arange(_STATES, dtype=np.uint8), (blocks, 1))
    for k in range(CHUNK):
        maps = table[row[k][:, None] + maps]
    # Prefix scan: after step k a map covers 2 ** (k + 1) chunks that end with its own.
    step = 1
    while step < blocks:
        joined = maps.copy()
        joined[step:] = np.take_along_axis(maps[step:], maps[:-step], axis=1)
        maps, step = joined, 2 * step

    state = np.zeros(blocks, dtype=np.uint8)
    state[1:] = maps[:-1, _OUT]
    before = np.empty((CHUNK, blocks), dtype=np.uint8)
    for k in range(CHUNK):
        before[k] = state
        state = table[row[k] + state]
    return before.T.reshape(-1)[:n]


def _byte_characters() -> list[str]:
    """The character that stands for each byte: itself if printable, else one from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class PieceTransducer:
    """Counts the tokens of one piece; transitions between tokens are compiled on demand."""

    def __init__(self, spec: dict):
        model = spec["model"]
        self.end = model["end_of_word_suffix"]
        self.vocabulary = set(model["vocab"])
        pairs = (tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"])
        self.ranks = {pair: rank for rank, pair in enumerate(pairs)}
        self.longest = max(map(len, self.vocabulary))
        self.characters = _byte_characters()
        self._meets: dict[tuple[str, str], bool] = {}

    def _merged(self, symbols: list[str]) -> list[str]:
        while len(symbols) > 1:
            ranked = [self.ranks.get(pair, 1 << 60) for pair in zip(symbols, symbols[1:])]
            best = min(ranked)
            if best == 1 << 60:
                break
            at = ranked.index(best)
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        return symbols

    def _meet(self, left: str, right: str) -> bool:
        """Whether the machine has a transition from ``left`` to ``right``."""
        known = self._meets.get((left, right))
        if known is None:
            closing = right.endswith(self.end) and len(right) > len(self.end)
            body = right[: -len(self.end)] if closing else right
            symbols = [*left, *body]
            if closing:
                symbols[-1] += self.end
            known = self._merged(symbols) == [left, right]
            if len(self._meets) < REMEMBERED:
                self._meets[left, right] = known
        return known

    def count(self, piece: bytes) -> int:
        """Tokens that the path through ``piece`` emits."""
        text = "".join([self.characters[b] for b in piece])
        n = len(text)
        if text + self.end in self.vocabulary:
            return 1  # one transition from the start to the end
        last: list[str] = [""] * (n + 1)  # state after each prefix
        emitted = [0] * (n + 1)
        vocabulary = self.vocabulary
        for stop in range(1, n + 1):
            suffix = self.end if stop == n else ""
            for start in range(max(0, stop - self.longest), stop):
                token = text[start:stop] + suffix
                if token in vocabulary and (not start or (last[start] and self._meet(last[start], token))):
                    last[stop], emitted[stop] = token, emitted[start] + 1
                    break
        return emitted[n]


class TokenCounter:
    """Counts of whole texts: scanner, piece transducer, and the counts met so far."""

    def __init__(self, spec: dict, classes: np.ndarray):
        self.pieces = PieceTransducer(spec)
        self.classes = classes
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.keys = np.zeros(0, dtype=np.uint64)
        self.counts = np.zeros(0, dtype=np.int32)

    def _plain(self, text: str) -> tuple[str, int]:
        """Text without special strings, in the vocabulary's normal form, and the number of those strings."""
        found = 0
        for special in self.special:
            if special in text:
                found += text.count(special)
                text = text.replace(special, " ")
        if not text.isascii():
            # Each character is lower-cased alone: no special form of sigma at a word's end.
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return text.lower(), found

    def _known(self, hashes: np.ndarray, spell: Callable[[int], bytes]) -> np.ndarray:
        """Counts of the pieces with these (distinct, sorted) hashes."""
        at = np.searchsorted(self.keys, hashes)
        found = np.zeros(len(hashes), dtype=bool)
        inside = at < len(self.keys)
        found[inside] = self.keys[at[inside]] == hashes[inside]
        counts = np.zeros(len(hashes), dtype=np.int32)
        counts[found] = self.counts[at[found]]
        new = np.flatnonzero(~found)
        counts[new] = [self.pieces.count(spell(k)) for k in new]
        if len(new) and len(self.keys) + len(new) <= REMEMBERED:
            self.keys = np.insert(self.keys, at[new], hashes[new])
            self.counts = np.insert(self.counts, at[new], counts[new])
        return counts

    def count(self, texts: list[str]) -> np.ndarray:
        plain = [self._plain(text) for text in texts]
        joined = "\n".join(text for text, _ in plain) + "\n"
        offsets = np.concatenate([[0], np.cumsum([len(text) + 1 for text, _ in plain])])
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        classes = self._with_contractions(codes)
        before = scan(classes)
        begin = _BEGINS.reshape(-1)[classes * np.uint8(_STATES) + before]
        starts = np.flatnonzero(begin)
        # A piece ends where the next begins or where white space follows it.
        blank = np.flatnonzero(classes == _SPACE)
        if not len(starts):
            return np.array([found for _, found in plain], dtype=np.int64)
        ends = np.minimum(np.append(starts[1:], len(codes)), blank[np.searchsorted(blank, starts)])
        hashes = words.span_hashes(codes, starts, ends)
        distinct, sample, which = np.unique(hashes, return_index=True, return_inverse=True)
        counts = self._known(distinct, lambda k: joined[starts[sample[k]] : ends[sample[k]]].encode())[which]
        first = np.searchsorted(starts, offsets)
        return words.sums_by_text(counts, first) + np.array([found for _, found in plain])

    def _with_contractions(self, codes: np.ndarray) -> np.ndarray:
        """Classes, with each apostrophe told apart by the letters after it."""
        classes = self.classes[codes]
        for at in np.flatnonzero(codes[:-1] == ord("'")):
            after = "".join(map(chr, codes[at + 1 : at + 3]))
            if after[:1] in _CONTRACTIONS_1:
                classes[at] = _APOSTROPHE_1
            elif after in _CONTRACTIONS_2:
                classes[at] = _APOSTROPHE_2
        return classes


_counters: dict[str, TokenCounter] = {}


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 2048) -> DataFrame:
    """Bytes and tokens of every whole text, and whether it has more tokens than ``limit``.

    Needs ``doc_id`` and ``text``; other columns are not looked at. ``vocabulary`` is the path of a
    byte-pair tokenizer description in JSON with an end-of-word suffix, read on the driver. Special
    strings inside a text are one token each, as the tokenizer does by default. A null text counts
    as empty (no bytes, no tokens), repeated rows and ids each give their own row, a null id stays
    null, an empty table gives an empty result. Nothing is shuffled; a worker remembers at most
    `REMEMBERED` piece counts.
    """
    with open(vocabulary, encoding="utf-8") as file:
        content = file.read()
    # Both have a fixed size that does not depend on the documents.
    shared = docs.sparkSession.sparkContext.broadcast((content, character_classes(json.loads(content))))

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counters.get(vocabulary)
        if counter is None:
            counter = _counters[vocabulary] = TokenCounter(json.loads(shared.value[0]), shared.value[1])
        for batch in words.text_chunks(batches):
            texts = [text or "" for text in batch.column("text").to_pylist()]
            n_bytes = np.diff(words.utf8(batch.column("text"))[1])
            n_tokens = counter.count(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_bytes), pa.array(n_tokens), pa.array(n_tokens > limit)],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return docs.select("doc_id", "text").mapInArrow(rows, SCHEMA)
