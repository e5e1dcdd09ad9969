"""Language identification by cross-parsing entropy.

For each language a suffix automaton is built over a sample of its labelled text. A text is parsed
against it: each phrase is the longest match with the sample from where the last phrase ended. The
language that needs the fewest phrases, normalised by the bits that point to a place in its sample,
wins.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sondelake.llm import words

#: Bounds of the fit: labels learned (the most frequent), rows and characters sampled of each.
MAX_LANGUAGES = 512
ROWS_PER_LANGUAGE = 64
CHARS_PER_ROW = 2048
#: Symbols of a language's sample, whatever the number of languages; its texts have even shares in them.
SAMPLE_SYMBOLS = 16384
#: Texts are parsed in stretches of this many symbols side by side; phrases go on from one to the next.
STRETCH = 512
#: Bytes of texts parsed together; the more stretches there are, the less a step costs each.
TOGETHER = 3 << 20

SCHEMA = "doc_id long, lang_pred string, score double, n_letters long, bits double"

_BLANK = 0
#: Places tried for a state's transitions before the search moves on; holes are left to states with one transition.
_TRIES = 16


@dataclass
class Automaton:
    """Transitions of one language in one array: that of a state by a symbol is at ``base[state] + symbol``.

    Symbols are numbered within the language, the first `len(letters)` by ``letters``; the next one stands
    for every symbol that its sample does not hold. A cell that another state owns is no transition.
    """

    letters: np.ndarray  # symbols of the model that the sample holds
    base: np.ndarray
    cells: np.ndarray  # next state, owner


@dataclass
class Model:
    languages: list[str]
    symbols: np.ndarray  # symbol of every code point; 0 is no letter, the last one a letter of no sample
    width: int  # symbols
    automata: list[Automaton]
    bits: np.ndarray  # bits of one phrase


def held_out(doc_id) -> F.Column:
    """The fifth of the documents that nothing is learned from; a missing id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def suffix_automaton(text: Iterable[int]) -> list[dict[int, int]]:
    """Transitions of the automaton of all substrings of ``text``; state 0 is the empty one."""
    edges: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for symbol in text:
        new = len(edges)
        edges.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and symbol not in edges[at]:
            edges[at][symbol] = new
            at = link[at]
        if at >= 0:
            target = edges[at][symbol]
            if length[target] == length[at] + 1:
                link[new] = target
            else:
                copy = len(edges)
                edges.append(dict(edges[target]))
                length.append(length[at] + 1)
                link.append(link[target])
                while at >= 0 and edges[at].get(symbol) == target:
                    edges[at][symbol] = copy
                    at = link[at]
                link[target] = link[new] = copy
        last = new
    return edges


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased code points of all texts and the text each belongs to."""
    lower = [text.lower() for text in texts]
    codes = np.frombuffer("".join(lower).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return codes, np.repeat(np.arange(len(lower)), [len(text) for text in lower])


def _letters() -> np.ndarray:
    return np.array([chr(code).isalpha() for code in range(0x110000)])


def _collapsed(symbols: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Positions that stay when each run of non-letters within a text becomes one blank."""
    keep = symbols != _BLANK
    keep[1:] |= (symbols[:-1] != _BLANK) & (owner[1:] == owner[:-1])
    return np.flatnonzero(keep)


def _shares(sizes: np.ndarray, total: int) -> np.ndarray:
    """Even shares of ``total`` in texts of these sizes; what short texts leave goes to the longer ones."""
    shares = np.zeros(len(sizes), dtype=np.int64)
    for done, k in enumerate(np.argsort(sizes, kind="stable")):
        shares[k] = min(sizes[k], total // (len(sizes) - done))
        total -= shares[k]
    return shares


def _automaton(text: np.ndarray) -> Automaton:
    """The suffix automaton of ``text``, whose states lie in each other's gaps."""
    letters, counts = np.unique(text, return_counts=True)
    order = np.argsort(-counts, kind="stable")  # frequent symbols side by side leave small gaps
    letters, rank = letters[order], np.argsort(order)
    edges = suffix_automaton(rank[np.searchsorted(np.sort(letters), text)].tolist())
    first = len(letters)  # so that no place is before the array
    base = np.full(len(edges), first, dtype=np.int64)
    used, low, most = bytearray(3 * first + 1), first, 0
    for state in sorted((k for k, out in enumerate(edges) if len(out) > 1), key=lambda k: -len(edges[k])):
        out = sorted(edges[state])
        at, tried = used.index(0, low), 1
        while any(used[at - out[0] + symbol] for symbol in out):
            at, tried = used.index(0, at + 1), tried + 1
            if at + 2 * first >= len(used):
                used.extend(bytes(len(used)))
        low = at if tried > _TRIES else low
        base[state] = at - out[0]
        for symbol in out:
            used[at - out[0] + symbol] = 1
        most = max(most, at - out[0] + out[-1])
        if most + 3 * first >= len(used):
            used.extend(bytes(len(used)))
    single = np.array([(k, *out, *out.values()) for k, out in enumerate(edges) if len(out) == 1], dtype=np.int64).reshape(-1, 3)
    free = np.flatnonzero(np.frombuffer(used, np.uint8)[first:] == 0)[: len(single)] + first
    free = np.concatenate([free, len(used) + np.arange(len(single) - len(free))])
    base[single[:, 0]] = free - single[:, 1]
    cells = np.full((base.max() + first + 1, 2), -1, dtype=np.int32)
    cells[free] = single[:, [2, 0]]
    for state, out in enumerate(edges):
        if len(out) > 1:
            cells[base[state] + np.array(list(out))] = [(target, state) for target in out.values()]
    return Automaton(letters, base.astype(np.int32), cells.reshape(-1).view(np.int64))


def build(samples: dict[str, list[str]]) -> Model:
    """A model from sample texts by language. Languages are taken in code point order."""
    languages = sorted(name for name, texts in samples.items() if any(map(str.isalpha, "".join(texts))))
    is_letter = _letters()
    codes, _ = _codes([text for name in languages for text in samples[name]])
    known = np.unique(codes[is_letter[codes]])
    symbols = np.zeros(0x110000, dtype=np.int32)
    symbols[is_letter] = len(known) + 1
    symbols[known] = np.arange(1, len(known) + 1)

    automata, bits = [], []
    for name in languages:
        codes, owner = _codes(samples[name])
        keep = _collapsed(symbols[codes], owner)
        sizes = np.bincount(owner[keep], minlength=len(samples[name]))
        at = np.arange(len(keep)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        text = symbols[codes[keep[at < _shares(sizes, SAMPLE_SYMBOLS)[owner[keep]]]]]
        automata.append(_automaton(text))
        bits.append(np.log2(len(text) + 1))
    return Model(languages, symbols, len(known) + 2, automata, np.array(bits))


def fit(docs: DataFrame) -> Model:
    """A model from the labelled documents that are not held out.

    The fit sees at most `ROWS_PER_LANGUAGE` different texts, of `CHARS_PER_ROW` characters each,
    of each label: those with the smallest hashes of their text, so that copies count once. Of these
    texts the first symbols go into the automaton, `SAMPLE_SYMBOLS` a label in even shares.
    """
    learn = docs.where(
        ~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").rlike("\\p{L}")
    ).select("lang", "text", F.xxhash64("text").alias("key"))
    counts = (
        learn.groupBy("lang").agg(F.approx_count_distinct("key").alias("n"))
        .orderBy(F.desc("n"), "lang").limit(MAX_LANGUAGES).collect()
    )
    if not counts:
        return build({})
    # Hashes are even over 64 bits: a bound on them keeps about as many texts as wanted, twice over.
    spans = {row.lang: min(1.0, 2 * ROWS_PER_LANGUAGE / row.n) for row in counts}
    bounds = F.create_map(*(F.lit(x) for lang, part in spans.items() for x in (lang, float(part))))
    place = F.col("key").cast("double") / 2.0**64 + 0.5
    chosen = (
        learn.withColumn("bound", bounds[F.col("lang")]).where(place <= F.col("bound"))
        .select("lang", "key", F.substring("text", 1, CHARS_PER_ROW).alias("text"))
        .dropDuplicates(["lang", "key"])
        .collect()
    )
    samples: dict[str, list[str]] = {}
    for row in sorted(chosen, key=lambda row: (row.lang, row.key)):
        texts = samples.setdefault(row.lang, [])
        if len(texts) < ROWS_PER_LANGUAGE:
            texts.append(row.text)
    return build(samples)


def _step(automaton: Automaton, state: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """States after one more symbol each, and phrases that end with it."""
    base, cells = automaton.base, automaton.cells
    found = cells[base[state] + symbol].view(np.int32)
    after = found[::2].copy()
    ended = np.zeros(len(state), dtype=np.uint8)
    # No transition: the phrase ends, and the next one begins with this symbol. A symbol that the
    # sample does not hold is a phrase of its own. At the start no phrase is open.
    miss = np.flatnonzero(found[1::2] != state)
    found = cells[base[0] + symbol[miss]].view(np.int32)
    known = found[1::2] == 0
    after[miss] = np.where(known, found[::2], 0)
    ended[miss] = 2 - known - (state[miss] == 0)
    return after, ended


def _phrases(automaton: Automaton, width: int, rows: np.ndarray, lengths: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Phrases that end within each column of ``rows``.

    Columns are stretches of texts, the longest first; ``before`` tells the column that comes before each
    in its text, or -1. All are parsed side by side as if no phrase were open at their start. Then those before
    which one is open are parsed again from the true state, until their states are those of the first
    time (most soon are). Where the end differs, the next stretch is looked at again.
    """
    local = np.full(width, len(automaton.letters), dtype=np.int32)
    local[automaton.letters] = np.arange(len(automaton.letters))
    active = np.searchsorted(-lengths, -np.arange(len(rows)), side="left")
    states = np.zeros(rows.shape, dtype=np.int32)
    ended = np.zeros(rows.shape, dtype=np.uint8)
    state = np.zeros(rows.shape[1], dtype=np.int32)
    for k, n in enumerate(active):
        if not n:
            break
        state[:n], ended[k, :n] = _step(automaton, state[:n], local[rows[k, :n]])
        states[k, :n] = state[:n]

    after = np.full(len(lengths), -1, dtype=np.int64)
    after[before[before >= 0]] = np.flatnonzero(before >= 0)
    ends = states[lengths - 1, np.arange(len(lengths))] if len(lengths) else state
    again = np.flatnonzero(before >= 0)
    again = again[ends[before[again]] != 0]
    while len(again):
        columns, state, changed = again, ends[before[again]], []
        for k in range(len(rows)):
            over = lengths[columns] == k
            changed.append(columns[over])  # their ends differ
            columns, state = columns[~over], state[~over]
            if not len(columns):
                break
            state, ended[k, columns] = _step(automaton, state, local[rows[k, columns]])
            apart = state != states[k, columns]
            columns, state = columns[apart], state[apart]
            states[k, columns] = state
        else:
            changed.append(columns)
        moved = np.concatenate(changed)
        ends[moved] = states[lengths[moved] - 1, moved]
        again = after[moved]
        again = again[again >= 0]
    return ended.sum(axis=0, dtype=np.int64)


def parse(model: Model, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Phrases that each text needs in each language, and its number of letters."""
    n_texts, n_languages = len(texts), len(model.languages)
    codes, owner = _codes(texts)
    symbols = model.symbols[codes]
    letters = np.bincount(owner[symbols != _BLANK], minlength=n_texts)
    keep = _collapsed(symbols, owner)
    symbols, owner = symbols[keep], owner[keep]
    sizes = np.bincount(owner, minlength=n_texts)
    stretches = -(-sizes // STRETCH)
    first = np.concatenate([[0], np.cumsum(stretches)])
    at = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    stretch = first[owner] + at // STRETCH
    # Long stretches first, so that those still being parsed are the first ones of every row.
    lengths = np.bincount(stretch, minlength=first[-1])
    order = np.argsort(-lengths, kind="stable")
    place = np.argsort(order)
    rows = np.zeros((STRETCH, first[-1]), dtype=np.int32)
    rows[at % STRETCH, place[stretch]] = symbols
    before = np.arange(-1, first[-1] - 1)
    before[first[:-1][stretches > 0]] = -1  # a text's first stretch has none before it
    before = np.where(before >= 0, place[before], -1)[order]
    phrases = np.zeros((n_texts, n_languages), dtype=np.int64)
    for k, automaton in enumerate(model.automata):
        sums = np.concatenate([[0], np.cumsum(_phrases(automaton, model.width, rows, lengths[order], before)[place])])
        phrases[:, k] = sums[first[1:]] - sums[first[:-1]]
    return phrases, letters


def predict(model: Model, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Language, score, letters and bits per letter of each text."""
    phrases, letters = parse(model, texts)
    if not model.languages:
        return ["und"] * len(texts), np.zeros(len(texts)), letters, np.zeros(len(texts))
    bits = (phrases + 1) * model.bits
    best = bits.argmin(axis=1)  # of equal costs the first language in code point order
    least = bits[np.arange(len(texts)), best]
    score = 1 / np.exp2(np.maximum(least[:, None] - bits, -1000)).sum(axis=1)
    named = [model.languages[k] if n else "und" for k, n in zip(best, letters)]
    return named, np.where(letters > 0, score, 0.0), letters, least / np.maximum(letters, 1)


def _side_by_side(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of about `TOGETHER` bytes of text; a longer text comes alone."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in words.text_chunks(batches):
        held.append(batch)
        size += pc.sum(pc.binary_length(batch.column("text"))).as_py() or 0
        if size >= TOGETHER:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _batches(shared: Broadcast, docs: DataFrame) -> DataFrame:
    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _side_by_side(batches):
            texts = [text or "" for text in batch.column("text").to_pylist()]
            named, score, letters, bits = predict(shared.value, texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(named, pa.string()), pa.array(score), pa.array(letters, pa.int64()), pa.array(bits)],
                names=["doc_id", "lang_pred", "score", "n_letters", "bits"],
            )

    return docs.select("doc_id", "text").mapInArrow(rows, SCHEMA)


def identify(docs: DataFrame) -> DataFrame:
    """Language of every whole text, learned from the labels of those not held out.

    Needs ``doc_id``, ``text`` and ``lang``; other columns are not looked at. Returns doc_id,
    held_out, lang_pred, score (the winner's share if every language's cost in bits is read as a
    likelihood), n_letters and bits (per letter). A text that is null or has no letter, and every
    text when nothing could be learned, is ``und`` with score 0. Of languages that cost the same
    the first by code point wins. Null labels and ids are not learned from; repeated rows each
    get their own row; an empty table gives an empty result. The model is bounded by the
    constants above and broadcast; documents are not shuffled.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit(docs))
    return _batches(model, docs).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "n_letters", "bits")


def with_language(docs: DataFrame) -> DataFrame:
    """The documents whose text has a language (not ``und``), with all their columns.

    When nothing could be learned, no text can be named; then those that have a letter are kept.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit(docs))

    def kept(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _side_by_side(batches):
            named, _, letters, _ = predict(model.value, [text or "" for text in batch.column("text").to_pylist()])
            keep = [name != "und" for name in named] if model.value.languages else letters > 0
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(kept, docs.schema)
